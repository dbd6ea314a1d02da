"""Merkle manifest against a plain recursive tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from reelhouse.llm import merkle
from tests.llm.conftest import CLASHING


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k:k + fanout]) for k in range(0, len(out[-1]), fanout)])
    return out


def climb(tree, i, digest, fanout):
    """(siblings, top) of node i with ``digest`` in its place."""
    siblings = []
    for level in tree[:-1]:
        run = level[i // fanout * fanout:i // fanout * fanout + fanout]
        k = i % fanout
        siblings += run[:k] + run[k + 1:]
        digest = H(*run[:k], digest, *run[k + 1:])
        i //= fanout
    return siblings, digest


def brute(rows, fanout=2):
    """rows: (doc_id, source, lang, n_chars, text)."""
    if not rows:
        return []
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    trees = {lang: levels([x[2] for x in sorted(group, key=lambda x: x[:3])], fanout) for lang, group in by.items()}
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    top = levels([trees[lang][-1][0] for lang in order], fanout)
    out = []
    for lang in order:
        for i, (_, _, own, r) in enumerate(sorted(by[lang], key=lambda x: x[:3])):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            claim = leaf((*r[:3], r[3] + 1, r[4])) if hit and r[3] is not None else own
            low, digest = climb(trees[lang], i, claim, fanout)
            high, digest = climb(top, order.index(lang), digest, fanout)
            out.append((r[0], own, trees[lang][-1][0], top[-1][0], H(*low, *high), digest, digest == top[-1][0]))
    return sorted(out, key=str)


def some_rows(n, langs, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(n)]), rng.choice([None, "web", "büch"]), rng.choice(langs),
             rng.choice([None, 0, 17]), rng.choice([None, "", "a:b", "ü" * 50])) for _ in range(n)]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("rows", [
    some_rows(300, ["en", "en", "en", "fr", None, ""]), some_rows(40, ["en"]), [(7, "s", "en", 3, "abc")],
    [(1, "s", "de", 1, "x")] * 9 + [(2, None, None, None, None)], some_rows(60, [f"l{k}" for k in range(30)])])
def test_manifest_equals_a_plain_tree(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = merkle.verified_manifest(docs)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("fanout,levels_", [(2, 1), (2, 3), (3, 2), (5, 1)])
def test_block_size_and_fanout(spark, fanout, levels_):
    rows = some_rows(130, ["en", "en", "fr", None], seed=fanout)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = merkle.manifest(docs, fanout=fanout, levels=levels_).withColumn("p", F.sha2("proof", 256))
    want = [(r[0], r[1], r[2], r[3], r[4], r[3]) for r in brute(rows, fanout)]  # nothing altered: the fold is the root
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.p, r.folded_root) for r in got.collect()), key=str) == sorted(want, key=str)


def test_edge_tables(spark, edge_docs, no_docs):
    more = edge_docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("x")).withColumn("tree", F.lit(1))
    rows = [tuple(r) for r in more.select("doc_id", "source", "lang", F.col("n_chars").cast("long"), "text").collect()]
    got = merkle.verified_manifest(more.withColumn("idx", F.lit(0)).withColumn("digest", F.lit("")))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    assert CLASHING[0] in edge_docs.columns
    assert merkle.verified_manifest(more.where("false")).count() == 0


def test_a_fold_resumes_the_kept_state():
    block = merkle.Block([H(str(k)) for k in range(5)], 3, 2)
    assert len(block.states[0]) == 5 and block.folded(4, H("4")) == block.top
    assert block.path(4) == ([H("3"), H(H("0"), H("1"), H("2"))], ["", ""])
    new = H("new")
    assert block.folded(3, new) == H(H(H("0"), H("1"), H("2")), H(new, H("4")))
    assert block.folded(0, new) == H(H(new, H("1"), H("2")), H(H("3"), H("4")))


def test_plan_has_no_single_task_exchange(spark, edge_docs):
    docs = edge_docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit("x"))
    plan = merkle.verified_manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan
