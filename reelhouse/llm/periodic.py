"""Runs (maximal periodic stretches) of words, by Baier's grouping.

A run is a stretch of consecutive words with smallest period q and at least
``max(least, 2 * q)`` words that neither neighbour extends with the same period.

Every run holds, under an order of the words or under the reversed order, its
period's Lyndon word as the longest Lyndon word that starts at some place.  The
first phase of Baier's suffix sorter gives these words directly: places are
grouped by their first word; groups are taken from the highest down; every
place of a group tells the nearest place before it that lies in a lower group, and the
places told k times move to a new group just above their own, whose word is theirs
followed by k copies of the told group's word.  In the end the group's word of a place
is its longest Lyndon word; its length is the Lyndon array.

Places of one group whose distance is the word's length are consecutive
copies of one root.  Such a chain is extended to both sides by the longest
common extension of two places one period apart, which ends within one period;
two periods or more make a run.  Both orders together give all runs.

Two words of a run that lie one period apart begin equal stretches, so every
word of a run lies in a stretch of ``least // 2`` words that its text holds
twice.  A batch is searched for such stretches by hash at once; runs of a text are
those of its parts that they cover, and only these parts are grouped.  The test passes
over nothing: hashes may only mark too much.  Words are told apart by their bytes.

Scale: a narrow map, no shuffle; time and memory in proportion to a text's
words (about 100 bytes a word while its longest part is grouped, with
typed arrays above ``WIDE`` words).

Defined cases: null and empty texts have no words and no runs (null run columns,
digests of the empty string); a null doc_id leaves the words as they are;
repeated rows are reported each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelhouse.llm.common import claim, columns, longs, tuned
from reelhouse.llm.words import mix64, windows

LEAST = 12
#: Parts longer than this are grouped in typed arrays instead of lists.
WIDE = 1 << 18
#: Words of texts that are searched at once.
SLICE_WORDS = 1 << 19
SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def lyndon_groups(rank: list[int], wide: int = WIDE) -> tuple[list[int], list[int]]:
    """(group, length) of each place: the group and the length of the longest Lyndon word
    that starts there.  ``rank`` are the words' places in the order (0, 1, ...).
    Places of one group have the same Lyndon word, and only these."""
    n = len(rank)
    make = list if n < wide else (lambda x: array("q", x))
    size = [0] * (max(rank) + 1)
    for r in rank:
        size[r] += 1
    begin, at = [0] * len(size), 0
    for r, s in enumerate(size):
        begin[r], at = at, at + s
    # a group is known by its first place in the sorted order and fills the
    # places up to the next group's; opens[last place] gives its first one
    group = make([begin[r] for r in rank])
    held: dict[int, object] = {}
    for i, g in enumerate(group):
        if g in held:
            held[g].append(i)
        else:
            held[g] = make([i])
    opens = make([0]) * n
    width, word = {}, {}
    for b, s in zip(begin, size):
        if s:
            opens[b + s - 1], width[b], word[b] = b, s, 1
    lower = make([-1]) * n
    last = n - 1
    while last >= 0:
        g = opens[last]
        last = g - 1
        length = word[g]
        told: dict[int, int] = {}
        for i in held.pop(g):
            if group[i] != g:
                continue  # moved to a higher group since
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = lower[j]
            lower[i] = j
            if j >= 0:
                told[j] = told.get(j, 0) + 1
        if not told:
            continue
        if len(told) == 1:
            (j, k), = told.items()
            moves = ((k, {group[j]: [j]}),)
        else:
            by: dict[int, dict[int, list[int]]] = {}
            for j, k in told.items():
                by.setdefault(k, {}).setdefault(group[j], []).append(j)
            moves = sorted(by.items(), reverse=True)
        for k, olds in moves:
            for old, places in olds.items():
                s = width[old]
                m = len(places)
                longer = word[old] + k * length
                if m == s:
                    word[old] = longer
                    if len(held[old]) != m:  # only now without those that moved
                        held[old] = make(sorted(places))
                    continue
                new = old + s - m
                places.sort()
                for j in places:
                    group[j] = new
                held[new] = make(places)
                width[new], width[old] = m, s - m
                word[new] = longer
                opens[old + s - 1], opens[new - 1] = new, old
    return group, [word[g] for g in group]


def _extended(text: np.ndarray, a: np.ndarray, b: np.ndarray, step: int, lockstep: int = 48) -> np.ndarray:
    """Longest common extension of places ``a`` and ``b`` in direction ``step``;
    ``text`` has values that occur once around every part."""
    out = np.zeros(len(a), np.int64)
    on = np.arange(len(a))
    for t in range(lockstep):
        if not len(on):
            return out
        on = on[text[a[on] + step * t] == text[b[on] + step * t]]
        out[on] += 1
    for k in on.tolist():
        x, y, t, block = int(a[k]), int(b[k]), lockstep, 256
        while True:
            if step > 0:
                p, q = text[x + t:x + t + block], text[y + t:y + t + block]
            else:
                p, q = text[max(0, x - t - block + 1):x - t + 1][::-1], text[max(0, y - t - block + 1):y - t + 1][::-1]
            m = min(len(p), len(q))
            differ = np.flatnonzero(p[:m] != q[:m])
            if len(differ):
                out[k] = t + int(differ[0])
                break
            t, block = t + m, block * 2
    return out


def _chains(group: np.ndarray, length: np.ndarray, own: np.ndarray):
    """(first, last, length) of chains: places of one group and part, one word apart."""
    order = np.lexsort((np.arange(len(group)), group, own))
    g, o, q = group[order], own[order], length[order]
    joined = (g[1:] == g[:-1]) & (o[1:] == o[:-1]) & (np.diff(order) == q[1:])
    edge = np.concatenate([[True], ~joined])
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(order)) - 1
    return order[begin], order[end], q[begin]


def part_runs(parts: list[list[int]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of every part (word numbers), sorted."""
    out: list[set] = [set() for _ in parts]
    sizes = np.array([len(p) for p in parts], np.int64)
    if not sizes.sum():
        return [[] for _ in parts]
    base = np.cumsum(sizes + 1) - sizes  # place of each part's first word
    text = np.empty(int(sizes.sum()) + len(parts) + 1, np.int64)
    walls = np.append(base - 1, len(text) - 1)
    text[walls] = -1 - np.arange(len(walls))
    own = np.repeat(np.arange(len(parts)), sizes)
    place = np.arange(len(own)) + own + 1
    text[place] = np.fromiter((w for p in parts for w in p), np.int64, len(own))
    for down in (False, True):
        groups, lengths = [], []
        for p in parts:
            rank = {w: r for r, w in enumerate(sorted(set(p), reverse=down))}
            g, q = lyndon_groups([rank[w] for w in p])
            groups.append(np.array(g, np.int64))
            lengths.append(np.array(q, np.int64))
        first, last, q = _chains(np.concatenate(groups), np.concatenate(lengths), own)
        part = own[first]
        a, b = place[first], place[last]
        right = _extended(text, b, b + q, 1)
        left = _extended(text, a - 1, a + q - 1, -1)
        whole = b - a + q + left + right
        good = np.flatnonzero(whole >= np.maximum(least, 2 * q))
        for k, start, n, period in zip(part[good].tolist(), (a - left - base[part])[good].tolist(), whole[good].tolist(), q[good].tolist()):
            out[k].add((start, n, period))
    return [sorted((s, n, p) for s, n, p in runs) for runs in out]


def _covered(numbers: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a stretch of ``least // 2`` words that their text holds twice."""
    width = max(1, least // 2)
    on = np.zeros(len(numbers) + 1, np.int64)
    begin = windows(mix64(numbers.astype(np.uint64) + np.uint64(1)), width)
    if len(begin):
        own = np.repeat(np.arange(len(first) - 1), np.diff(first))
        inside = own[:len(begin)] == own[width - 1:]
        at = np.flatnonzero(inside)
        with np.errstate(over="ignore"):
            key = begin[at] + mix64(own[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        np.add.at(on, at[twice], 1)
        np.add.at(on, at[twice] + width, -1)
    return np.cumsum(on)[:-1] > 0


def text_runs(texts: list[list], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Runs of every text, given as lists of words (any hashable values)."""
    table: dict = {}
    number = count()
    flat = [table[w] if w in table else table.setdefault(w, next(number)) for words in texts for w in words]
    numbers = np.array(flat, np.int64)
    first = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
    on = np.zeros(len(numbers) + 2, np.int8)
    on[1:-1] = _covered(numbers, first, least)
    begins = on[1:-1] > on[:-2]
    begins[first[:-1][first[:-1] < len(numbers)]] |= on[1:-1][first[:-1][first[:-1] < len(numbers)]] > 0
    begin = np.flatnonzero(begins)
    stops = on[1:-1] > on[2:]
    tails = first[1:][first[1:] > 0] - 1
    stops[tails] |= on[1:-1][tails] > 0
    end = np.flatnonzero(stops) + 1
    fit = end - begin >= least
    begin, end = begin[fit], end[fit]
    out: list[list] = [[] for _ in texts]
    texts_of = (np.searchsorted(first, begin, "right") - 1).tolist()
    for t, b, runs in zip(texts_of, begin.tolist(), part_runs([flat[b:e] for b, e in zip(begin.tolist(), end.tolist())], least)):
        out[t] += [(b - int(first[t]) + s, n, q) for s, n, q in runs]
    return out


def looped(words: list, doc_id: int | None) -> list:
    """``words`` with a periodic tail in a tenth of all documents: the planted
    transformation of the registered query."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[:n - a]


def collapsed(words: list, runs) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, n, q in runs:
        edge[start + q] += 1
        edge[start + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _row(words: list[bytes], runs):
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (len(runs), *shown, _digest("".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2]))).encode()),
            _digest(b" ".join(collapsed(words, runs))))


def periodic_runs(docs: DataFrame, least: int = LEAST, change=looped) -> DataFrame:
    """One row per document row, see ``SCHEMA``.  ``change(words, doc_id)``
    gives the words that are looked at (``None``: as they are)."""
    tuned(docs.sparkSession)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches):
        claim("periodic")
        for batch in batches:
            ids, text = columns(batch, "doc_id", "text")
            keys = ids.cast(pa.int64()).to_pylist()
            held, room, rows = [], 0, []

            def flush():
                rows.extend(_row(words, runs) for words, runs in zip(held, text_runs(held, least)))
                held.clear()

            for key, value in zip(keys, text):
                # bytes.split() parts at 0x20 and 0x09 to 0x0D, as the words do
                words = (value.as_py() or "").encode().split()
                held.append(change(words, key) if change else words)
                room += len(words)
                if room >= SLICE_WORDS:
                    flush()
                    room = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), *(pa.array([r[k] for r in rows], pa.string() if "sha256" in name else pa.int64())
                                         for k, name in enumerate(names[1:]))], names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
