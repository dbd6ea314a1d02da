"""Removal of word passages that repeat across documents, by level-wise doubling.

Words are `[^\\x20\\x09-\\x0D]+`, unchanged.  A window is ``window`` consecutive
words of one document.  Every word covered by a window whose word sequence
also starts in a document with a smaller doc_id is removed; windows are judged on the
input, not on what is left.

Levels have the lengths ..., ceil(window / 4), ceil(window / 2), window.  At a
level of length L each still possible window is represented by the smallest
hash among its L-word windows.  That choice depends on the window's content
alone, so equal windows have equal representatives, and one representative stands for
many neighbouring windows.  Representatives seen in one document only are
dropped with their windows; only windows repeated at one length are looked at
with twice the length.  Windows surviving all levels are compared on their own
96-bit hashes, and the smallest document of each hash decides.

Scale: each level shuffles (hash, document) rows, reduced to min and max per
hash before the shuffle; no group is gathered anywhere, a passage shared by
a third of all documents is one pre-aggregated row per task and a join that AQE splits.
Documents with equal word sequences collapse to the smallest id before the
first level (all words of the others are removed when they reach one window).

Defined cases: null and empty texts have no words; a document shorter than
the window keeps all; rows with a null doc_id neither lose words nor make
others lose any; rows of one doc_id are one document to the rule (never smaller than itself), and
each row is reported; other columns are ignored; empty input, empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import claim, columns, keep, sha, tuned
from reelhouse.llm.words import SPACE_WORDS, buffers, split_words, windows

WINDOW = 50
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def level_lengths(window: int, smallest: int = 12) -> list[int]:
    """Lengths below ``window`` that double up to it."""
    out, n = [], window
    while (n := -(-n // 2)) >= smallest:
        out.append(n)
    return out[::-1]


def sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) of every ``width`` neighbours: running
    values from both ends of blocks of ``width``, then one combination."""
    n = len(x)
    if n < width:
        return x[:0]
    pad = -n % width
    neutral = x.max() if op is np.minimum else x.min()
    blocks = np.concatenate([x, np.full(pad, neutral, x.dtype)]).reshape(-1, width)
    left = op.accumulate(blocks, axis=1).ravel()
    right = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(right[:n - width + 1], left[width - 1:n])


def representatives(hashes: np.ndarray, window: int, length: int) -> np.ndarray:
    """For each window, the smallest hash of its ``length``-word windows."""
    return sliding(windows(hashes, length, salt=length), window - length + 1, np.minimum)


def _spans(words, i):
    return slice(words.first[i], words.first[i + 1])


def _text(data, words, i, gone=None) -> bytes:
    """Words of text i joined by one space, without those flagged ``gone``."""
    s, e = words.start[_spans(words, i)], words.end[_spans(words, i)]
    if gone is not None:
        s, e = s[~gone], e[~gone]
    if not len(s):
        return b""
    size = e - s + 1
    take = np.repeat(s - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out = data[np.minimum(take, len(data) - 1)]
    out[np.cumsum(size) - 1] = 32
    return out[:-1].tobytes()


def _profile(docs: DataFrame, window: int, length: int) -> DataFrame:
    """Per row: word count, digest of all words, sequence key and tag, and
    the distinct representatives of its windows at the first level."""

    def run(batches):
        claim("substrings")
        for batch in batches:
            ids, text = columns(batch, "doc_id", "text")
            data, offsets = buffers(text)
            words = split_words(data, offsets, SPACE_WORDS)
            n = np.diff(words.first)
            digest, key, tag, reps = [], [], [], []
            for i in range(len(n)):
                joined = _text(data, words, i)
                digest.append(sha(joined))
                k = hashlib.blake2b(joined, digest_size=16).digest()
                key.append(k)
                tag.append(int.from_bytes(k[:4], "little") >> 2)
                h = words.hashes[0][_spans(words, i)]
                reps.append(np.unique(representatives(h, window, length)).view(np.int64) if n[i] >= window else None)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(digest), pa.array(key, pa.binary()),
                 pa.array(tag, pa.int64()), pa.array(reps, pa.list_(pa.int64()))],
                ["doc_id", "n_words", "digest", "seq", "tag", "reps"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, digest string, seq binary, tag long, reps array<long>")


def _repeated(rows: DataFrame) -> DataFrame:
    """Representatives, per document, that occur in two documents or more."""
    # written, so the join shuffles both sides and a representative of very many documents is split
    shared = keep(rows.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h"),
                  "substrings-shared")
    return rows.join(shared, "h").groupBy("doc_id", "tag").agg(F.collect_list("h").alias("alive"))


def _alive(batch, window, done):
    """Per text of a candidate batch: hashes and the flags of windows whose
    representatives at the levels ``done`` are all repeated ones."""
    data, offsets = buffers(columns(batch, "text")[0])
    words = split_words(data, offsets, SPACE_WORDS, salts=(1, 2))
    lists = [columns(batch, f"alive{length}")[0].to_pylist() for length in done]
    for i in range(len(offsets) - 1):
        h = words.hashes[0][_spans(words, i)]
        on = np.ones(max(0, len(h) - window + 1), bool)
        for length, alive in zip(done, lists):
            on &= np.isin(representatives(h, window, length), np.array(alive[i], np.int64).view(np.uint64))
        yield words, i, h, on


def repeated_windows(candidates: DataFrame, window: int, done: list[int]) -> DataFrame:
    """(doc_id, tag, at) of windows that start in a smaller document too."""

    def run(batches):
        claim("substrings")
        for batch in batches:
            ids, tags = (c.to_pylist() for c in columns(batch, "doc_id", "tag"))
            for words, i, h, on in _alive(batch, window, done):
                at = np.flatnonzero(on)
                if len(at):
                    one = windows(h, window, 7)[at].view(np.int64)
                    two = (windows(words.hashes[1][_spans(words, i)], window, 8)[at] >> np.uint64(33)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one), pa.array(two), pa.array(np.full(len(at), ids[i])),
                         pa.array((tags[i] << 32) + at)], ["h1", "h2", "doc_id", "at"])

    rows = candidates.mapInArrow(run, "h1 long, h2 int, doc_id long, at long")
    low = keep(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").drop("hi"),
               "substrings-low")
    return rows.join(low, ["h1", "h2"]).where("lo < doc_id").select("doc_id", "at")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_sha256."""
    tuned(docs.sparkSession)
    lengths = level_lengths(window) or [window]
    profile = keep(_profile(docs, window, lengths[0]), "substrings-profile")
    first = keep(profile.where("doc_id is not null and reps is not null").groupBy("seq").agg(F.min("doc_id").alias("lead")),
                 "substrings-lead")
    lead = profile.join(first, "seq", "left")
    own = lead.where("doc_id = lead").select("doc_id", "tag", "reps")
    alive = _repeated(own.select("doc_id", "tag", F.explode("reps").alias("h")).distinct())

    def tagged(batches):
        for batch in batches:
            data, offsets = buffers(columns(batch, "text")[0])
            words = split_words(data, offsets, SPACE_WORDS)
            tag = [int.from_bytes(hashlib.blake2b(_text(data, words, i), digest_size=16).digest()[:4], "little") >> 2
                   for i in range(len(offsets) - 1)]
            ok = pa.array([t == u for t, u in zip(tag, columns(batch, "tag")[0].to_pylist())])
            yield batch.filter(ok)

    named = alive.withColumnRenamed("alive", f"alive{lengths[0]}")
    schema = f"doc_id long, text string, tag long, alive{lengths[0]} array<long>"
    candidates = keep(docs.select("doc_id", "text").join(named, "doc_id").select("doc_id", "text", "tag", f"alive{lengths[0]}")
                      .mapInArrow(tagged, schema).dropDuplicates(["doc_id", "tag"]), "substrings-candidates")
    done = [lengths[0]]
    for length in lengths[1:]:
        def next_level(batches, length=length, done=tuple(done)):
            for batch in batches:
                ids, tags = (c.to_pylist() for c in columns(batch, "doc_id", "tag"))
                for words, i, h, on in _alive(batch, window, done):
                    if on.any():
                        reps = np.unique(representatives(h, window, length)[on]).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(reps), ids[i])), pa.array(np.full(len(reps), tags[i])), pa.array(reps)],
                            ["doc_id", "tag", "h"])

        alive = _repeated(candidates.mapInArrow(next_level, "doc_id long, tag long, h long"))
        candidates = keep(candidates.join(alive.withColumnRenamed("alive", f"alive{length}"), ["doc_id", "tag"]),
                          "substrings-candidates")
        done.append(length)

    marks = repeated_windows(candidates, window, done)
    marks = marks.groupBy("doc_id", F.shiftright("at", 32).alias("tag")).agg(
        F.collect_list(F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")).alias("at"))

    def cut(batches):
        for batch in batches:
            ids, tags, at = (c.to_pylist() for c in columns(batch, "doc_id", "tag", "at"))
            data, offsets = buffers(columns(batch, "text")[0])
            words = split_words(data, offsets, SPACE_WORDS)
            removed, digest = [], []
            for i, starts in enumerate(at):
                n = int(words.first[i + 1] - words.first[i])
                edge = np.zeros(n + window + 1, np.int64)
                np.add.at(edge, np.array(starts), 1)
                np.add.at(edge, np.array(starts) + window, -1)
                gone = np.cumsum(edge)[:n] > 0
                removed.append(int(gone.sum()))
                digest.append(sha(_text(data, words, i, gone)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tags, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest)],
                                             ["doc_id", "tag", "n_cut", "cut_digest"])

    changed = candidates.select("doc_id", "tag", "text").join(marks, ["doc_id", "tag"]).mapInArrow(
        cut, "doc_id long, tag long, n_cut long, cut_digest string")
    copy = F.col("lead") < F.col("doc_id")
    return lead.select("doc_id", "n_words", "digest", "tag", "lead").join(changed, ["doc_id", "tag"], "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(sha(b""))).otherwise(F.coalesce("cut_digest", "digest")).alias("kept_sha256"))
