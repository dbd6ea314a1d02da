"""The document pipeline, stage by stage against plain Python."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from reelhouse.llm import secretscan, toxicity
from reelhouse.llm.common import keep, table
from tests.llm.test_dedup import brute_components, brute_contamination
from tests.llm.test_extraction import brute_base

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, out = table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, keep(stage(spark, docs, SMALL), f"test-{name}")
        out.append((before, docs))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_are_registered_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_neardup", "decontamination", "secret_scan", "word_bpe"]
    assert "pipeline" in __spark_entry__.queries() and corpus_pipeline.ORACLE_SQL is None


def test_all_but_the_last_stage_return_documents(stages):
    for before, after in stages[:-1]:
        assert after.columns == COLUMNS and 0 < after.count() <= before.count()


def test_toxicity_stage(spark, stages):
    before, after = stages[0]
    chain = toxicity.fit(before, table(spark, SMALL, "labels"))
    at = {w: k for k, w in enumerate(chain.words)}
    kept = set()
    for i, t in pairs(before):
        words = [w.lower() for w in re.findall(rb"[A-Za-z\x80-\xff]+", t.encode())]
        own = {b"=" + w for w in words if len(w) <= 8} | {b"^" + w[:n] for w in words for n in range(3, 9) if n <= len(w)}
        score = np.array(chain.bias) + sum((chain.weights[at[f]] for f in own if f in at), np.zeros(len(chain.names)))
        p = []
        for k in range(len(chain.names)):
            p.append(1 / (1 + np.exp(-(score[k] + (np.dot(chain.earlier[k], p) if k else 0)))))
        if p[-1] < chain.threshold:
            kept.add(i)
    assert {i for i, _ in pairs(after)} == kept
    labels = {r.doc_id: r.toxic for r in table(spark, SMALL, "labels").collect()}
    known = [(labels[i] == 0, i in kept) for i, _ in pairs(before) if i in labels]
    assert sum(a == b for a, b in known) / len(known) > 0.95


def test_near_duplicate_stage(stages):
    before, after = stages[1]
    lead = {c[0] for c in brute_components(pairs(before), 5) if c[3]}
    assert sorted(i for i, _ in pairs(after)) == sorted(lead)


def test_decontamination_stage(spark, stages):
    before, after = stages[2]
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    clean = {c[0] for c in brute_contamination(pairs(before), items) if not c[5]}
    assert {i for i, _ in pairs(after)} == clean


def test_secret_stage(stages):
    before, after = stages[3]
    new = dict(pairs(after))
    assert len(new) == before.count()
    for i, t in pairs(before):
        if not brute_base(t):
            linked = secretscan.linked_spans(t, [])
            assert linked or new[i] == t
        else:
            assert not brute_base(new[i]) and new[i] != t
    assert {r.doc_id for r in after.where("n_chars = length(text)").collect()} >= {i for i, t in pairs(before) if new[i] != t}


def test_encoding_stage(stages):
    before, after = stages[4]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(pairs(before))
    got = after.collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (list(r.ids), r.n_tokens) == (ids, len(ids))
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
