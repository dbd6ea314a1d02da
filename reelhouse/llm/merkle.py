"""Merkle manifest of a dataset, as a tree of SHA-256 midstates.

A leaf is the digest of one row's fields, each ``-`` when null, else its UTF-8
byte count, ``:`` and its value.  The rows of one group (a language) ascend by
key; every ``fanout`` consecutive nodes become the digest of their joined hex
digests, level by level, until one node, the subroot, remains.  Subroots, in
the order of their groups (null first, then bytewise), give the root likewise.

A parent keeps a copy of its hash state from before each child slot.  Folding
a replaced child therefore resumes the state of that slot, takes in the
replacement and the siblings to the right, and never the left ones again.

Scale: leaves are digested by the JVM and written; a range sort of the short
(group, key, digest) rows and counts per (partition, group) give every leaf its
position, so a group that holds most rows is spread over all tasks.  Trees are
folded in aligned blocks of ``fanout ** levels`` nodes: one task holds one block.  Block
tops are the next round's nodes (a few rounds at any size).  On the way down each
block learns the siblings above it once, and its members' proofs and folds
are made from these.  Hash states cannot be stored, so a block that is folded is built again
from its digests.  The driver holds one number per round.

Defined cases: null keys come first, rows of one key are ordered by digest;
repeated rows are leaves of their own; a group of one row has its leaf as
subroot, one group alone its subroot as root; an empty table gives no rows;
columns other than key and fields are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import columns, keep, tuned

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, LEVELS = 2, 9
SCHEMA = "doc_id long, leaf string, subroot string, root string, proof string, folded_root string"
_NODE, _PATH = "tree string, idx long, n long, digest string", "tree string, idx long, lefts array<string>, rights array<string>, root string"


def depth(n: int, fanout: int) -> int:
    """Levels until ``n`` nodes are one."""
    out = 0
    while n > 1:
        n, out = -(-n // fanout), out + 1
    return out


class Block:
    """Nodes of one aligned block, folded ``levels`` times.  Per level and
    child: the parent's hash state before the child's slot, and the
    siblings' digests to its left and right."""

    def __init__(self, digests: list[str], fanout: int, levels: int):
        self.fanout, self.states, self.lefts, self.rights = fanout, [], [], []
        for _ in range(levels):
            parents, states, lefts, rights = [], [], [], []
            for c in range(0, len(digests), fanout):
                kids, state = digests[c:c + fanout], sha256()
                for k, kid in enumerate(kids):
                    states.append(state.copy())
                    lefts.append("".join(kids[:k]))
                    rights.append("".join(kids[k + 1:]))
                    state.update(kid.encode())
                parents.append(state.hexdigest())
            for kept, level in ((self.states, states), (self.lefts, lefts), (self.rights, rights)):
                kept.append(level)
            digests = parents
        self.top = digests[0]

    def path(self, i: int) -> tuple[list[str], list[str]]:
        """Left and right siblings of child ``i``, level by level."""
        lefts, rights = [], []
        for left, right in zip(self.lefts, self.rights):
            lefts.append(left[i])
            rights.append(right[i])
            i //= self.fanout
        return lefts, rights

    def folded(self, i: int, digest: str) -> str:
        """The top with child ``i`` replaced by ``digest``."""
        for states, rights in zip(self.states, self.rights):
            digest = resumed(states[i], digest, rights[i])
            i //= self.fanout
        return digest


def resumed(state, digest: str, rights: str) -> str:
    state = state.copy()
    state.update((digest + rights).encode())
    return state.hexdigest()


def field(column: Column) -> Column:
    """One field of a leaf."""
    text = column.cast("string")
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def _placed(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (tree, key, digest, ...) with ``idx``, their position in their
    tree by (key, digest), and ``n``, the tree's size."""
    spark = rows.sparkSession
    order = ("tree", "key", "digest", "tie")
    placed = keep(rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
                  .sortWithinPartitions(*order).drop("tie").withColumn("at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("part", "tree").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    runs = keep(runs.select("part", "tree", (F.sum("c").over(tree.orderBy("part")) - F.col("c") - F.col("first")).alias("shift"),
                            F.sum("c").over(tree).alias("n")), f"{name}-runs")
    return placed.join(runs, ["part", "tree"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift", "key")


def _block(rows: pa.Table, fanout: int, levels: int) -> tuple[pa.Table, Block]:
    """The rows of one block in order, and the block."""
    rows = rows.sort_by("idx")
    return rows, Block(rows["digest"].to_pylist(), fanout, min(levels, depth(rows["n"][0].as_py(), fanout)))


def _rounds(nodes: DataFrame, fanout: int, levels: int, name: str) -> list[DataFrame]:
    """Nodes of every round: the given ones first, one per tree at last."""
    width = fanout ** levels

    def up(rows):
        rows, block = _block(rows, fanout, levels)
        first = rows.slice(0, 1).to_pylist()[0]
        return pa.Table.from_pylist([{"tree": first["tree"], "idx": first["idx"] // width,
                                      "n": -(-first["n"] // width), "digest": block.top}], _arrow(_NODE))

    rounds = [nodes]
    while True:
        above = rounds[-1].select("tree", "idx", "n", "digest").groupBy("tree", F.expr(f"idx div {width}").alias("block"))
        rounds.append(keep(above.applyInArrow(up, _NODE), name))
        if (rounds[-1].agg(F.max("n")).first()[0] or 0) <= 1:
            return rounds


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


def _down(nodes: DataFrame, paths: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Paths to the root of ``nodes`` from those of their parents."""
    width = fanout ** levels

    def down(rows, above):
        rows, block = _block(rows, fanout, levels)
        up, out = above.to_pylist()[0], []
        for i, (tree, idx) in enumerate(zip(rows["tree"].to_pylist(), rows["idx"].to_pylist())):
            lefts, rights = block.path(i)
            out.append({"tree": tree, "idx": idx, "lefts": lefts + up["lefts"], "rights": rights + up["rights"], "root": up["root"]})
        return pa.Table.from_pylist(out, _arrow(_PATH))

    return nodes.select("tree", "idx", "n", "digest").groupBy("tree", F.expr(f"idx div {width}").alias("block")).cogroup(
        paths.groupBy("tree", "idx")).applyInArrow(down, _PATH)


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
             altered: dict[str, Column] | None = None, when: Column | None = None,
             fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: key, leaf, subroot, root, proof and folded root.

    ``proof`` joins the digests (64 characters each) of the leaf's siblings, level by
    level from leaf to root, left to right.  ``folded_root`` is the root that the proof gives for
    the row as it is claimed to be now: ``altered`` replaces fields in rows where
    ``when`` holds; without it, the row itself.
    """
    tuned(docs.sparkSession)
    rows = docs.select(*(F.col(c) for c in dict.fromkeys((key, group, *fields))))
    claimed = leaf([(altered or {}).get(c, F.col(c)) for c in fields])
    rows = keep(rows.select(
        # one string per group that no value shares with the null, in the groups' order
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"), F.col(key).alias("key"),
        leaf([F.col(c) for c in fields]).alias("digest"),
        (F.when(when, claimed) if when is not None else F.lit(None).cast("string")).alias("claim"),
        F.monotonically_increasing_id().alias("tie")), "merkle-leaves")
    leaves = keep(_placed(rows.withColumn("id", F.col("key")), "merkle-order"), "merkle-placed")
    trees = _rounds(leaves, fanout, levels, "merkle-nodes")
    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("tree").alias("id"), "digest",
                                F.lit(0).alias("tie"))
    subroots = keep(_placed(subroots, "merkle-subroots"), "merkle-subroots")
    tops = _rounds(subroots, fanout, levels, "merkle-tops")
    none = F.array().cast("array<string>")
    paths = tops[-1].select("tree", "idx", none.alias("lefts"), none.alias("rights"), F.col("digest").alias("root"))
    for nodes in tops[-2::-1]:
        paths = keep(_down(nodes, paths, fanout, levels), "merkle-paths")
    paths = paths.join(subroots.select("idx", F.col("id").alias("of")), "idx").select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("idx"), "lefts", "rights", "root")
    for nodes in trees[-2:0:-1]:
        paths = keep(_down(nodes, paths, fanout, levels), "merkle-paths")
    paths = paths.join(trees[-1].select("tree", F.col("digest").alias("subroot")), "tree")
    width = fanout ** levels

    def prove(rows, above):
        rows, block = _block(rows, fanout, levels)
        up = above.to_pylist()[0]
        tail = "".join(a + b for a, b in zip(up["lefts"], up["rights"]))
        states = [(sha256(a.encode()), b) for a, b in zip(up["lefts"], up["rights"])]
        leaves, proofs, roots = rows["digest"].to_pylist(), [], []
        for i, (digest, claim) in enumerate(zip(leaves, rows["claim"].to_pylist())):
            lefts, rights = block.path(i)
            proofs.append("".join(a + b for a, b in zip(lefts, rights)) + tail)
            top = block.folded(i, claim or digest)
            for state, right in states:
                top = resumed(state, top, right)
            roots.append(top)
        n = len(leaves)
        return pa.table([rows["id"], pa.array(leaves), pa.array([up["subroot"]] * n), pa.array([up["root"]] * n),
                         pa.array(proofs), pa.array(roots)], [key, "leaf", "subroot", "root", "proof", "folded_root"])

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {SCHEMA.split(', ', 1)[1]}"
    return leaves.groupBy("tree", F.expr(f"idx div {width}").alias("block")).cogroup(
        paths.groupBy("tree", "idx")).applyInArrow(prove, schema)


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, proven for a copy in which ``n_chars`` is one
    more wherever 7 divides the CRC-32 of the decimal doc_id."""
    more = (F.col("n_chars").cast("decimal(38,0)") + 1)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest(docs, altered={"n_chars": more}, when=F.coalesce(hit, F.lit(False)))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
