"""Runs of words against brute force over all periods."""

import hashlib
import random
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelhouse.llm import periodic
from tests.llm.conftest import by_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(s, least=12):
    n, out = len(s), []
    for q in range(1, n // 2 + 1):
        x = 0
        while x < n - q:
            if s[x] != s[x + q]:
                x += 1
                continue
            y = x
            while y < n - q and s[y] == s[y + q]:
                y += 1
            size = y - x + q
            part = s[x:y + q]
            if size >= max(least, 2 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((x, size, q))
            x = y
    return sorted(out)


def brute_row(i, text, least=12):
    w = WORD.findall(text or "")
    n = len(w)
    if i is not None and n and zlib.crc32(str(i).encode()) % 10 == 0:
        g = zlib.crc32(str(i).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]
    runs = brute_runs(w, least)
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    shown = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    text = "".join(f"{s},{size},{q}\n" for s, size, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (i, len(runs), *shown, hashlib.sha256(text.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 14), st.integers(1, 9), st.integers(0, 40))
def test_runs_equal_brute_force(word, least, period, cut):
    looped = (word[:period] * 8)[:cut] + word
    for s in (word, looped, word + looped):
        assert periodic.part_runs([s], least)[0] == brute_runs(s, least)
        assert periodic.text_runs([[], s, s[::-1]], least) == [[], brute_runs(s, least), brute_runs(s[::-1], least)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_groups_are_longest_lyndon_words(s):
    def lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))
    group, length = periodic.lyndon_groups([sorted(set(s)).index(x) for x in s], wide=random.choice([1, 1000]))
    words = []
    for i in range(len(s)):
        words.append(tuple(s[i:i + max(k for k in range(1, len(s) - i + 1) if lyndon(s[i:i + k]))]))
    assert length == [len(w) for w in words]
    assert len({(g, w) for g, w in zip(group, words)}) == len(set(words)) == len(set(group))
    assert [w for _, w in sorted(set(zip(group, words)))] == sorted(set(words))


def doc_rows():
    rng, rows = random.Random(5), [(None, None), (None, "a " * 20), (1, None), (2, ""), (3, " \n\t"), (4, "a b " * 6), (4, "a b " * 6)]
    for i in range(5, 160):
        w = [rng.choice("abcdeé") * rng.randint(1, 2) for _ in range(rng.randint(0, 90))]
        if i % 3 == 0 and w:
            k = rng.randrange(len(w))
            w = w[:k] + (w[k:k + 7] * 9)[:rng.randint(1, 60)] + w[k:]
        rows.append((i, rng.choice([" ", "\n", "\x0b"]).join(w)))
    return rows


@pytest.mark.parametrize("slice_words", [1, 500, 1 << 19])
def test_rows_equal_brute_force(spark, monkeypatch, slice_words):
    monkeypatch.setattr(periodic, "SLICE_WORDS", slice_words)
    rows = doc_rows()
    assert any(i is not None and zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t in rows)
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert by_id(got) == sorted((brute_row(i, t) for i, t in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_edges(edge_docs, edge_rows, no_docs):
    short = [(i, t) for i, t in edge_rows if len(t or "") < 10_000]
    got = {tuple(r) for r in periodic.periodic_runs(edge_docs).collect()}
    assert {brute_row(i, t) for i, t in short} <= got and len([i for i, _ in edge_rows]) == edge_docs.count()
    assert periodic.periodic_runs(no_docs).count() == 0


def test_hard_texts_in_time():
    thue, a, b = [0], [0], [0, 1]
    while len(thue) < 4000:
        thue += [1 - x for x in thue]
    while len(b) < 3000:
        a, b = b, b + a
    assert periodic.part_runs([thue[:300]])[0] == brute_runs(thue[:300])
    assert periodic.part_runs([b[:300]])[0] == brute_runs(b[:300])
    start = time.time()
    assert periodic.part_runs([thue, b])[0][0][2] == 8
    assert periodic.part_runs([[0] * 300_000]) == [[(0, 300_000, 1)]]
    assert periodic.part_runs([list(range(50_000)) * 2]) == [[(0, 100_000, 50_000)]]
    assert time.time() - start < 60


def test_long_words_are_told_apart(spark):
    """Words whose polynomial hashes modulo 2**64 agree are different words."""
    one = "a"
    for _ in range(11):
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([one, other] * 8)), (2, " ".join([one] * 16)), (3, " ".join([other, one, one] * 5))]
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string"), change=None)
    assert [(r.period, r.length) for r in got.orderBy("doc_id").collect()] == [(2, 16), (1, 16), (3, 15)]
