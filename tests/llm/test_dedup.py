"""Near duplicates, repeated passages and decontamination by brute force."""

import hashlib
import itertools
import os
import random
import re

import numpy as np
import pytest

from reelhouse.llm import decontaminate, neardup, substrings
from reelhouse.llm.common import components
from reelhouse.llm.words import LOWER, SPACE_WORDS, buffers, split_words
from tests.llm.conftest import by_id, words

SPACED, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def brute_components(rows, width):
    sets = []
    for _, t in rows:
        w = SPACED.findall(lower(t))
        sets.append({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (i, a), (j, b) in itertools.combinations([(r[0], s) for r, s in zip(rows, sets)], 2):
        if i is not None and j is not None and i != j and a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i), True if i is None else find(i) == i) for (i, _), s in zip(rows, sets)]


def variants(seed, n=40, size=60):
    """Texts edited more and more: chains of links."""
    rng, base, rows = random.Random(seed), words(seed, size).split(), []
    for i in range(n):
        base = list(base)
        base[rng.randrange(size)] = f"w{i}"
        rows.append((100 + rng.randrange(10_000) * n + i, " ".join(base)))
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_near_duplicates_equal_brute_force(spark, edge_docs, edge_rows, block):
    assert by_id(neardup.near_duplicates(edge_docs, 4, block_docs=block, hot_band=block)) == order(brute_components(edge_rows, 4))
    rows = variants(1) + variants(2, size=25)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert by_id(neardup.near_duplicates(docs, 4, block_docs=block, hot_band=block)) == order(brute_components(rows, 4))


def templated(n, share, copies, seed=9):
    """``n`` texts, half of them around one template of ``share`` of their words; then ``copies`` near copies of some."""
    rng = random.Random(seed)
    template, rows = words(seed, int(200 * share)).split(), []
    for i in range(n):
        own = [f"{rng.randrange(10 ** 9)}" for _ in range(200 - (len(template) if i % 2 else 0))]
        rows.append((i, " ".join([*template, *own] if i % 2 else own)))
    for k in range(copies):
        w = rows[rng.randrange(n)][1].split()
        w[rng.randrange(len(w))] = "edited"
        rows.append((n + k, " ".join(w)))
    return rows


def test_a_shared_template_makes_no_candidates(spark):
    """Half of all rows share a template (similarity about 0.2): what is sent to
    be confirmed follows the true links as the corpus doubles, and no link is lost."""
    sent = []
    for n in (600, 1200):
        rows = templated(n, 0.33, n // 20)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        reps = neardup.distinct_sets(neardup.keep(neardup.signatures(docs, 4), "t-sig"))
        for hot in (1024, 16):
            grouped = neardup.candidate_groups(reps, hot_band=hot)
            sent.append(grouped.count())
            assert sent[-1] <= 2.5 * (n // 20), (n, hot, sent)
            largest = grouped.groupBy("component").count().agg({"count": "max"}).first()[0]
            assert largest <= 8
        if n == 600:
            assert by_id(neardup.near_duplicates(docs, 4, hot_band=16)) == order(brute_components(rows, 4))


def test_members_of_a_hot_band_all_meet(spark):
    """Two alike members whose only common band is a hot one stay a pair, whatever the band's size."""
    rng = random.Random(4)
    rows = [(k, 100, [1, 1000 + k], [rng.getrandbits(63) for _ in range(4)]) for k in range(20)]
    rows[13] = (13, 100, [1, 1013], rows[2][3])
    reps = spark.createDataFrame(rows, "rep long, n_shingles long, bands array<long>, sig array<long>")
    for hot in (1024, 16, 4):
        assert [tuple(r) for r in neardup.candidate_pairs(reps, hot_band=hot).distinct().collect()] == [(2, 13)], hot


@pytest.mark.parametrize("n,size", [(250, 90), (500, 300)])
def test_recall_of_pairs_just_above_the_threshold(spark, n, size):
    """Pairs at 0.80 to 0.85, against their exact similarity."""
    rng, rows, due = random.Random(n), [], set()
    for k in range(n):
        w = [f"w{rng.randrange(10 ** 9)}" for _ in range(size + 3)]
        other, k2 = list(w), 0
        while True:  # edit words until the pair is near the threshold
            at = rng.randrange(size)
            other[at] = f"e{rng.randrange(10 ** 9)}"
            a, b = ({tuple(x[i:i + 4]) for i in range(size)} for x in (w, other))
            j = len(a & b) / len(a | b)
            k2 += 1
            if j < 0.85:
                break
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(other))]
        if j >= 0.8:
            due.add(2 * k)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 4)
    linked = {r.component_id for r in got.where("component_id <> doc_id").collect()}
    assert linked <= due and len(due) > n / 4
    assert len(linked) >= 0.99 * len(due), (len(linked), len(due))


def test_spanning_pairs_connect_what_all_likely_pairs_connect():
    rng = np.random.default_rng(5)
    base = [rng.integers(0, 2 ** 63, 100, dtype=np.uint64) for _ in range(6)]
    sets = [np.unique(np.concatenate([base[k % 6][:97], rng.integers(0, 2 ** 63, 3, dtype=np.uint64)])) for k in range(60)]
    sigs = np.stack([neardup.packed(neardup.minima(s)) for s in sets])
    sizes = np.array([len(s) for s in sets])
    for few in (1, 8, 100):
        for keys, across in ((np.zeros(60, np.int64), -np.ones(60, np.int64)), (np.arange(60) // 7, -np.ones(60, np.int64)),
                             (np.zeros(60, np.int64), (np.arange(60) >= 30).astype(np.int64))):
            i, j = neardup.spanning_pairs(keys, across, sigs, sizes, 80, neardup.FLOOR, few)
            label = np.arange(60)
            want = np.arange(60)
            for a, b in zip(i, j):
                assert keys[a] == keys[b] and (across[a] < 0 or across[a] != across[b])
                label[label == label[b]] = label[a]
            for a, b in itertools.combinations(range(60), 2):
                if keys[a] == keys[b] and a % 6 == b % 6 and (across[a] < 0 or across[a] != across[b]):
                    want[want == want[b]] = want[a]
            assert all((label[a] == label[b]) == (want[a] == want[b]) for a, b in itertools.combinations(range(60), 2))


def test_dropping_keeps_one_of_each_group_and_all_columns(edge_docs, edge_rows, no_docs):
    kept = neardup.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    lead = {(i, t) for (i, t), c in zip(edge_rows, brute_components(edge_rows, 5)) if c[3]}
    got = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    assert len(got) == len([x for x in got if x[0] is not None]) + 2 and set(got) == lead
    assert neardup.near_duplicates(no_docs, 4).count() == 0 and neardup.drop_near_duplicates(no_docs).count() == 0


def test_which_of_equal_rows_stays_does_not_depend_on_the_layout(spark):
    text = words(8, 40)
    rows = [(1, text, k, f"s{k % 3}") for k in range(30)] + [(2, text, 0, "x"), (3, words(9, 40), 1, None), (3, words(9, 40), 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int, source string")
    got = [sorted(map(tuple, neardup.drop_near_duplicates(docs.repartition(n, "extra") if n else docs.orderBy(docs.extra.desc())).collect()), key=str)
           for n in (0, 2, 7)]
    assert got[0] == got[1] == got[2] and [r[0] for r in got[0]] == [1, 3]


def test_packed_estimate_is_close():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 1000, dtype=np.uint64)
    for share in (0.3, 0.6, 0.9):
        same = int(1000 * 2 * share / (1 + share))
        other = np.concatenate([base[:same], rng.integers(0, 2 ** 63, 1000 - same, dtype=np.uint64)])
        got = neardup.estimate(neardup.packed(neardup.minima(base)), neardup.packed(neardup.minima(other))[None, :])[0]
        assert abs(got - share) < 0.2


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 300 + i) for i in range(50)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}


def brute_repeats(rows, window):
    starts = {}
    for i, t in rows:
        w = SPACED.findall(t or "")
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                starts[key] = min(starts.get(key, i), i)
    out = []
    for i, t in rows:
        w = SPACED.findall(t or "")
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and starts[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [50, 13])
def test_repeats_equal_brute_force(spark, edge_docs, edge_rows, window):
    assert by_id(substrings.remove_repeats(edge_docs, window)) == order(brute_repeats(edge_rows, window))


def test_repeats_in_shuffled_and_periodic_texts(spark, no_docs):
    rng = random.Random(9)
    parts = [words(k, 30) for k in range(6)] + ["la " * 40]
    rows = [(k, " ".join(rng.choice(parts) for _ in range(4)) + f" {k}") for k in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert by_id(substrings.remove_repeats(docs)) == order(brute_repeats(rows, 50))
    assert substrings.remove_repeats(no_docs).count() == 0
    assert substrings.level_lengths(50) == [13, 25] and substrings.level_lengths(13) == []


def brute_contamination(rows, items):
    patterns = {}
    for item, t in items:
        w = ALNUM.findall(lower(t))
        m = min(10, len(w))
        if item is not None and t is not None:
            for k in range(len(w) - m + 1 if m else 0):
                patterns.setdefault(tuple(w[k:k + m]), set()).add(str(item))
    out = []
    for i, t in rows:
        w, hit, found = ALNUM.findall(lower(t)), set(), set()
        for k in range(len(w)):
            for m in {len(p) for p in patterns}:
                if tuple(w[k:k + m]) in patterns and k + m <= len(w):
                    hit.update(range(k, k + m))
                    found |= patterns[tuple(w[k:k + m])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("shard", [4_000_000, 40])
def test_contamination_equals_brute_force(spark, edge_docs, edge_rows, shard):
    passage = dict(edge_rows)[10].split()
    items = [(1, " ".join(passage[32:50]).upper()), (2, " ".join(passage[33:45])), (3, "two, three"), (4, None), (5, ""), (6, "a"),
             (None, "one"), (7, "TWO -- three"), (3, "two three"), (11, " ".join(passage[85:92]))]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS words")
    rows = [r for r in edge_rows if r[0] not in (20, 21)]
    docs = edge_docs.where("coalesce(doc_id, 0) not in (20, 21)")
    want = brute_contamination(rows, items)
    assert by_id(decontaminate.contamination(docs, bench, shard_chars=shard)) == order(want)
    clean = decontaminate.drop_contaminated(docs, bench, shard_chars=shard)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(w[0]) for w in want if not w[5])
    assert decontaminate.drop_contaminated(docs, bench.where("false")).count() == len(rows)
    assert decontaminate.contamination(docs.where("false"), bench).count() == 0


def test_large_benchmark_is_sent_in_bounded_shards(spark, monkeypatch):
    sent, alive, real = [], [], type(spark.sparkContext).broadcast

    def watched(sc, rows):
        held = real(sc, rows)
        sent.append(sum(len(t) for _, t in rows))
        alive.append(held)
        assert all(b._path is None or not os.path.exists(b._path) for b in alive[:-1])  # the shards before are gone
        return held
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", watched)
    long = words(21, 400).split()
    docs = spark.createDataFrame([(1, " ".join(long[50:70])), (1, "nothing here"), (2, " ".join(long)), (None, None)], "doc_id long, text string")
    items = [("long", " ".join(long)), ("long", " ".join(long)), ("short", " ".join(long[5:8])), ("none", None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert by_id(decontaminate.contamination(docs, bench, shard_chars=900)) == order(brute_contamination(rows, items))
    assert len(sent) > 1 and max(sent) <= 900


@pytest.mark.parametrize("limit", [1, 60, 10_000])
def test_pieces_hold_every_window_once(limit):
    lengths = np.array([len(w) for w in words(22, 90).split()])
    for n in (0, 1, 9, 10, 11, 90):
        cut = decontaminate.cut_item(lengths[:n], 10, limit)
        m = min(10, n)
        assert [s for a, b, _ in cut for s in range(a, b - m + 1)] == list(range(n - m + 1 if m else 0))
        assert all(size <= limit or b - a == m for a, b, size in cut)
        assert all(size >= lengths[a:b].sum() + b - a - 1 for a, b, size in cut)


def test_words_across_slices_equal_python(monkeypatch):
    from reelhouse.llm import words as W
    import pyarrow as pa
    texts = ["", "Ab cd", None, "x" * 50, " é ñandú\tz ", words(8, 300), "end"]
    whole = split_words(*buffers(pa.array(texts)), SPACE_WORDS, LOWER)
    monkeypatch.setattr(W, "SLICE", 17)
    data, offsets = buffers(pa.array(texts))
    cut = split_words(data, offsets, SPACE_WORDS, LOWER)
    assert (cut.start == whole.start).all() and (cut.hashes[0] == whole.hashes[0]).all()
    got = [[data[s:e].tobytes().decode() for s, e in zip(cut.start[a:b], cut.end[a:b])] for a, b in zip(cut.first[:-1], cut.first[1:])]
    assert got == [SPACED.findall(t or "") for t in texts]
