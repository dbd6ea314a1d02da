"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts and benchmark items are lower-cased (A-Z) and cut into words
`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`.  Patterns are the windows of
``window`` consecutive item words; an item with fewer words, but not none, is
one pattern of its own length.  For each pattern length m there is a block
shift table (blocks of two words) that says how far a search position may jump
without missing an occurrence; where the shift is 0, the patterns in the
bucket of the position's suffix block are compared word by word (first word,
then all word hashes, then the bytes).

All texts of a batch are searched in lock step: each is cut into segments
(overlapping by m - 1 words) whose positions advance together by the looked-up
shifts, so only about one word in m is touched.

Benchmark items are cut into pieces of whole windows by Spark (each window is in
one piece of its item, so a long item spreads over shards) and reach the tasks in
shards of at most ``shard_chars`` characters, a window counting as at least
``WINDOW_LEAST``; only a hash bucket of pieces (about a ``FINE``-th of a shard) that
is larger by itself goes beyond, as with one very long window.  A benchmark of one shard is one narrow map over the documents.  For a larger one the documents
are written once with a row key, each shard is collected, searched for in one map
that writes its hits by row key, and dropped before the next is collected; the
hits are joined back at the end.  So the driver holds one shard at a time, and a
benchmark of any size costs linear passes.

Defined cases: a null or empty text has no words (0 counts, not contaminated);
items with a null id, or without words, take no part; repeated rows are judged
each on its own; equal windows of several items count for each of these items;
other columns of the documents are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import claim, columns, fresh, keep, sha, tuned
from reelhouse.llm.words import ALNUM_WORDS, LOWER, buffers, groups, seeds, split_words
from reelhouse.session import scratch_path

WINDOW = 10
SHARD_CHARS = 4_000_000
WINDOW_LEAST = 8
FINE = 16  # pieces have at most this part of a shard, and shards are filled from buckets of about this part
SEGMENT = 512
_PAIR = seeds(1, 40)[0] | np.uint64(1)

SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


class WuManber:
    """Patterns of one length: shift table, suffix buckets, direct compare."""

    def __init__(self, width: int, hashes: np.ndarray, texts: list[bytes], items: list[list[str]]):
        self.width, self.texts, self.items = width, texts, items
        self.block = min(2, width)
        blocks = self._blocks(hashes.reshape(-1)).reshape(len(hashes), width)[:, self.block - 1:] if width > 1 else hashes
        self.bits = np.uint64(64 - max(12, (16 * blocks.size).bit_length()))
        slots = blocks >> self.bits
        self.shift = np.full(1 << int(64 - self.bits), width - self.block + 1, np.int32)
        for back in range(blocks.shape[1]):
            np.minimum.at(self.shift, slots[:, blocks.shape[1] - 1 - back], back)
        order = np.argsort(slots[:, -1], kind="stable")
        self.hashes = hashes[order]
        self.texts = [texts[i] for i in order]
        self.items = [items[i] for i in order]
        self.suffix = slots[order, -1]

    @staticmethod
    def _blocks(h: np.ndarray) -> np.ndarray:
        """Block hash ending at each word (of the word and the one before)."""
        with np.errstate(over="ignore"):
            out = h * _PAIR
            out[1:] += h[:-1]
            return (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)

    def find(self, data, words, first):
        """(start word, pattern) of all occurrences within the texts."""
        m, h = self.width, words.hashes[0]
        segments, limits = [], []
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= m:
                at = np.arange(a, b - m + 1, SEGMENT)
                segments.append(at)
                limits.append(np.minimum(at + SEGMENT, b - m + 1))
        if not segments:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        block = self._blocks(h) if m > 1 else h
        slot = block >> self.bits
        p, stop = np.concatenate(segments) + m - 1, np.concatenate(limits) + m - 1
        found = []
        while len(p):
            step = self.shift[slot[p]]
            hit = step == 0
            if hit.any():
                found.append(p[hit])
                step = np.maximum(step, 1)
            p = p + step
            on = p < stop
            p, stop = p[on], stop[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end = np.concatenate(found)
        low, high = np.searchsorted(self.suffix, slot[end], "left"), np.searchsorted(self.suffix, slot[end], "right")
        n = high - low
        start = np.repeat(end - m + 1, n)
        pattern = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        same = h[start] == self.hashes[pattern, 0]
        start, pattern = start[same], pattern[same]
        same = (h[start[:, None] + np.arange(m)] == self.hashes[pattern]).all(1)
        start, pattern = start[same], pattern[same]
        sure = [b" ".join(LOWER[data[words.start[i]:words.end[i]]].tobytes() for i in range(s, s + m)) == self.texts[q]
                for s, q in zip(start.tolist(), pattern.tolist())]
        return start[sure], pattern[sure]


def compile_items(rows: list[tuple[str, str]], window: int) -> list[WuManber]:
    """Matchers, one per pattern length, of (item id, text) rows."""
    data, offsets = buffers(pa.array([t for _, t in rows], pa.large_string()))
    words = split_words(data, offsets, ALNUM_WORDS, LOWER)
    by: dict[int, dict[bytes, tuple[np.ndarray, set]]] = {}
    for (item, _), a, b in zip(rows, words.first[:-1], words.first[1:]):
        m = min(window, int(b - a))
        tokens = [LOWER[data[s:e]].tobytes() for s, e in zip(words.start[a:b], words.end[a:b])]
        for i in range(b - a - m + 1) if m else ():
            by.setdefault(m, {}).setdefault(b" ".join(tokens[i:i + m]), (words.hashes[0][a + i:a + i + m], set()))[1].add(item)
    return [WuManber(m, np.stack([h for h, _ in found.values()]), list(found), [sorted(x) for _, x in found.values()])
            for m, found in sorted(by.items())]


_compiled: dict = {}


def _matchers(shard: Broadcast, window: int) -> list[WuManber]:
    """Compiled once per worker and broadcast; the last one is kept."""
    key = (shard._jbroadcast if hasattr(shard, "_jbroadcast") and shard._jbroadcast else id(shard), window)
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = (shard, compile_items(shard.value, window))
    return _compiled[key][1]


def _search(matchers, data, offsets):
    """Per text: word count, hit flags of its words, items found."""
    words = split_words(data, offsets, ALNUM_WORDS, LOWER)
    cover = np.zeros(len(words.start) + 1, np.int32)
    n = len(offsets) - 1
    items = [set() for _ in range(n)]
    for matcher in matchers:
        for a, b in groups(words.first, 1 << 18):
            start, pattern = matcher.find(data, words, words.first[a:b + 1])
            np.add.at(cover, start, 1)
            np.add.at(cover, start + matcher.width, -1)
            for doc, q in set(zip((np.searchsorted(words.first, start, "right") - 1).tolist(), pattern.tolist())):
                items[doc].update(matcher.items[q])
    return words.first, np.cumsum(cover[:-1]) > 0, items


def cut_item(lengths: np.ndarray, window: int, limit: int) -> list[tuple[int, int, int]]:
    """(first word, end word, size) of the pieces of an item with words of these
    lengths: as many windows each as ``limit`` holds, one at least."""
    m = min(window, len(lengths))
    ends = np.concatenate([[0], np.cumsum(lengths + 1)])  # of words joined by one space, and a space
    out, at, n = [], 0, len(lengths) - m + 1 if m else 0
    while at < n:
        fit = int(np.searchsorted(ends, ends[at] + limit + 1, "right")) - 1 - m - at + 1  # windows from ``at`` on
        take = max(1, min(fit, limit // WINDOW_LEAST, n - at))
        stop = at + take - 1 + m
        out.append((at, stop, max(int(ends[stop] - ends[at]) - 1, WINDOW_LEAST * take)))
        at += take
    return out


def pieces(bench: DataFrame, window: int, shard_chars: int) -> DataFrame:
    """Items cut into pieces: item_id, text, size."""
    limit = max(1, shard_chars // FINE)

    def run(batches):
        for batch in batches:
            ids, texts = columns(batch, "item_id", "text")
            data, offsets = buffers(texts)
            words = split_words(data, offsets, ALNUM_WORDS, LOWER)
            rows = []
            for item, a, b in zip(ids.to_pylist(), words.first[:-1], words.first[1:]):
                start, end = words.start[a:b], words.end[a:b]
                for i, j, size in cut_item(end - start, window, limit):
                    text = b" ".join(LOWER[data[s:e]].tobytes() for s, e in zip(start[i:j], end[i:j])).decode()
                    rows.append((item, text, size))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                                             ["item_id", "text", "size"])

    bench = bench.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    return bench.mapInArrow(run, "item_id string, text string, size long").distinct()


def _shards(bench: DataFrame, window: int, shard_chars: int) -> list[DataFrame]:
    """Pieces of the benchmark as tables of about ``shard_chars`` characters
    at most, each to be collected on its own."""
    cut = keep(pieces(bench, window, shard_chars), "benchmark-pieces")
    total = cut.agg(F.sum("size")).first()[0] or 0
    if total <= shard_chars:
        return [cut]
    bucket = F.pmod(F.xxhash64("item_id", "text"), F.lit(FINE * -(-total // shard_chars)))
    out, begin, held = [], 0, 0
    for k, size in sorted(map(tuple, cut.groupBy(bucket.alias("k")).agg(F.sum("size")).collect())):
        if held and held + size > shard_chars:
            out.append((begin, k))
            begin, held = k, 0
        held += size
    out.append((begin, None))
    return [cut.where((bucket >= a) & (bucket < b) if b is not None else bucket >= a) for a, b in out]


def _send(shard: DataFrame) -> Broadcast:
    return shard.sparkSession.sparkContext.broadcast([tuple(r) for r in shard.select("item_id", "text").collect()])


def _one_pass(docs: DataFrame, shard: Broadcast, window: int, finish, schema) -> DataFrame:
    """``finish(batch, first, hit, items)`` makes each batch."""
    def search(batches):
        claim("decontaminate")
        matchers = _matchers(shard, window)
        for batch in batches:
            yield finish(batch, *_search(matchers, *buffers(columns(batch, "text")[0])))

    return docs.mapInArrow(search, schema)


def _hits(docs: DataFrame, key: str, shards: list[DataFrame], window: int) -> DataFrame:
    """(row key, hit word, null) and (row key, null, item), one shard after the other."""
    path, schema = scratch_path(docs.sparkSession, "benchmark-hits"), "row long, word long, item string"

    def finish(batch, first, hit, items):
        rows = columns(batch, key)[0].to_numpy(zero_copy_only=False)
        at = np.flatnonzero(hit)
        doc = np.searchsorted(first, at, "right") - 1
        found = [(r, x) for r, own in zip(rows.tolist(), items) for x in sorted(own)]
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([rows[doc], np.array([r for r, _ in found], np.int64)]), pa.int64()),
            pa.array((at - first[doc]).tolist() + [None] * len(found), pa.int64()),
            pa.array([None] * len(at) + [x for _, x in found], pa.string())], ["row", "word", "item"])

    for shard in shards:
        sent = _send(shard)
        _one_pass(docs.select(key, "text"), sent, window, finish, schema).write.mode("append").parquet(path)
        sent.destroy()
    return docs.sparkSession.read.schema(schema).parquet(path)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents written once with a row key, and the key's name."""
    key = fresh("_row_key", docs.columns)
    return keep(docs.withColumn(key, F.monotonically_increasing_id()), "keyed-documents"), key


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items,
    items_sha256 (of the found item ids, sorted as strings), contaminated."""
    tuned(docs.sparkSession)
    shards, docs = _shards(bench, window, shard_chars), docs.select("doc_id", "text")

    def finish(batch, first, hit, items):
        n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[first])
        return pa.RecordBatch.from_arrays([
            columns(batch, "doc_id")[0].cast(pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(n_hit, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()), pa.array([sha(",".join(sorted(x)).encode()) for x in items]),
            pa.array(n_hit > 0)], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    if len(shards) == 1:
        return _one_pass(docs, _send(shards[0]), window, finish, SCHEMA)
    docs, key = _keyed(docs)

    def count(batches):
        for batch in batches:
            first = split_words(*buffers(columns(batch, "text")[0]), ALNUM_WORDS, LOWER).first
            ids, rows = columns(batch, "doc_id", key)
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), rows, pa.array(np.diff(first), pa.int64())], ["doc_id", "row", "n_words"])

    found = _hits(docs, key, shards, window).distinct().groupBy("row").agg(
        F.count("word").alias("n_hit"), F.count("item").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return docs.mapInArrow(count, "doc_id long, row long, n_words long").join(found, "row", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns unchanged."""
    tuned(docs.sparkSession)
    shards = _shards(bench, window, shard_chars)

    def finish(batch, first, hit, items):
        n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[first])
        return batch.filter(pa.array(n_hit == 0))

    if len(shards) == 1:
        return _one_pass(docs, _send(shards[0]), window, finish, docs.schema)
    names = docs.columns
    docs, key = _keyed(docs)
    hit = _hits(docs, key, shards, window).where("word is not null").select(F.col("row").alias(key)).distinct()
    return docs.join(hit, key, "left_anti").select([F.col(f"`{n}`") for n in names])
