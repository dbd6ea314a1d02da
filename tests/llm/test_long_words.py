"""Long words that polynomial hashes modulo 2**64 cannot tell apart."""

import hashlib
import zlib

import numpy as np
import pytest

from reelhouse.llm import neardup, substrings, tokencount, tokenfiles, wordbpe
from reelhouse.llm.pieces import vocabulary, vocabulary_path
from reelhouse.llm.words import LOWER, SPACE_WORDS, buffers, split_words
from tests.llm.conftest import words


def thue_morse(levels):
    a, b = "a", "b"
    for _ in range(levels):
        a, b = a + b, b + a
    return a, b


PAIRS = [thue_morse(k) for k in range(4, 14)]
TEXTS = [w for pair in PAIRS for w in pair] + [f"x {a} {b} {a}." for a, b in PAIRS]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1)


def test_hashes_differ():
    import pyarrow as pa
    found = split_words(*buffers(pa.array(TEXTS[:20])), SPACE_WORDS, LOWER, salts=(1, 2))
    assert all(len(np.unique(h)) == 20 for h in found.hashes)


def test_token_ids_and_counts_equal_the_library(spark, docs):
    byte = vocabulary(vocabulary_path(tokenfiles.VOCABULARY))[0]
    word = vocabulary(vocabulary_path(wordbpe.VOCABULARY))[0]
    want = [e.ids for e in byte.encode_batch(TEXTS, add_special_tokens=False)]
    assert [r.n_tokens for r in tokencount.token_counts(docs).orderBy("doc_id").collect()] == [len(x) for x in want]
    got = tokenfiles.written_and_read(docs).orderBy("doc_id").collect()
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array([*x, 2], "<u4").tobytes()) for x in want]
    ids = [" ".join(map(str, e.ids)) for e in word.encode_batch(TEXTS, add_special_tokens=False)]
    assert [r.ids_sha256 for r in wordbpe.encoded(docs).orderBy("doc_id").collect()] == [hashlib.sha256(x.encode()).hexdigest() for x in ids]


def test_windows_and_shingles_of_long_words_stay_apart(spark):
    rows = []
    for k, (a, b) in enumerate(PAIRS):
        rest = words(100 + k, 59).split()
        for j, w in enumerate((a, b)):
            rows.append((10 * k + j, " ".join([*rest[:30], w, *rest[30:]])))
        rows.append((10 * k + 2, " ".join([a, b] * 30)))
        rows.append((10 * k + 3, " ".join([b, a] * 2 + [a, b] * 28)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs).collect()}
    for k in range(len(PAIRS)):
        assert kept[10 * k + 1] == 0, k  # every window of 50 of 60 words holds the one that differs
    brute = {}
    for i, t in sorted(rows):
        w = t.split()
        gone = set()
        for s in range(len(w) - 49):
            if brute.setdefault(tuple(w[s:s + 50]), i) < i:
                gone |= set(range(s, s + 50))
        assert kept[i] == len(gone), i
    groups = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, 4).collect()}
    for i, t in rows:
        w = t.lower().split()
        assert groups[i][0] == len({tuple(w[s:s + 4]) for s in range(len(w) - 3)})
