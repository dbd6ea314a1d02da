"""MinHash near-duplicate detection with b-bit signatures.

A document's set holds the distinct shingles of ``shingle`` consecutive words
(words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; with fewer words the whole
sequence is one shingle).  Documents link when
``100 * |A n B| >= percent * |A u B|``; components of the links are the groups.

Steps:

1. *Signatures* (Arrow map): 128 minima per set.  Band keys hash the full
   minima (32 bands of 4); then only the low 2 bits of each minimum are kept,
   packed into four longs.
2. *Equal sets* collapse to their smallest id (partial ``min`` per set key),
   so any number of copies is one representative from here on.
3. *Bands*: representatives that share a band key meet with their packed
   signatures alone (32 bytes each).  These are compared by xor and bit counts;
   corrected for the 1/4 chance agreement of 2-bit minima they estimate the
   similarity.  Pairs estimated at ``floor`` or more (0.8 lies 5 standard errors
   above the default) are candidates; documents that only share a template are not.
   At a similarity of 0.8 a pair misses all bands with probability (1 - 0.8^4)^32 = 5e-8.
   A band of more than ``hot_band`` members is dealt into blocks, one run of rows
   per pair of blocks, so all its pairs meet: how many members a band has decides where they are compared, not whether.
4. *Confirmation*: components of the candidate pairs are groups; a group is dealt into hash blocks bounded by documents and by
   shingles, one task group per pair of blocks.  Inside, pairs that pass the estimate
   are confirmed on full shingle sets, unless both
   are already in one confirmed component.  Only a spanning edge per document
   leaves the task, never all pairs.
5. Components of the confirmed edges give the smallest id reachable.

Defined cases: a null or empty text, or one without words, has the empty set
and is linked with nothing; rows with a null doc_id stay alone (component_id
null, kept true); repeated rows share a component and each reports it; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import claim, columns, components, fresh, keep, tuned
from reelhouse.llm.words import LOWER, SPACE_WORDS, buffers, groups, mix64, seeds, split_words, windows

HASHES, BANDS, BITS = 128, 32, 2
ROWS = HASHES // BANDS
FLOOR = 0.59
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 750_000
#: Members from which a band is dealt into blocks.
HOT_BAND = 1024

_A = (seeds(HASHES, 50) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (seeds(HASHES, 51) >> np.uint64(32)).astype(np.uint32)
_BAND = seeds(HASHES, 52) | np.uint64(1)
_LOW = seeds(HASHES, 53)


def shingle_sets(data, offsets, width: int):
    """Sorted distinct 64-bit shingle hashes of each text, one array each."""
    words = split_words(data, offsets, SPACE_WORDS, LOWER)
    hashes = words.hashes[0]
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        n = b - a
        yield np.unique(windows(hashes[a:b], min(width, n))) if n else hashes[:0]


def minima(values: np.ndarray) -> np.ndarray:
    """128 minima of one set (multiply-add permutations of 32-bit hashes)."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    low = None
    for a in range(0, len(x), 512):
        part = (x[a:a + 512, None] * _A + _B).min(0)
        low = part if low is None else np.minimum(low, part)
    return low


def band_keys(sig: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = mix64(sig.astype(np.uint64) + _BAND) * _BAND
        keys = mixed.reshape(BANDS, ROWS).sum(1) + np.arange(BANDS, dtype=np.uint64)
    return mix64(keys).view(np.int64)


def packed(sig: np.ndarray) -> np.ndarray:
    """Low ``BITS`` bits of the (mixed) minima, packed into four longs.

    The minima are mixed first: low bits of a multiply-add depend on the low
    bits of its input alone."""
    with np.errstate(over="ignore"):
        low = (mix64(sig.astype(np.uint64) + _LOW) & np.uint64(3)).astype(np.uint64)
    shift = (np.arange(32, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(low.reshape(4, 32) << shift, axis=1).view(np.int64)


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of packed signature ``one`` to each row of ``many``:
    agreeing minima by bit counts, less the share that agrees by chance."""
    x = one.view(np.uint64) ^ many.view(np.uint64)
    x = (x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)
    agree = 1 - np.bitwise_count(x).sum(1) / HASHES
    chance = 2.0 ** -BITS
    return (agree - chance) / (1 - chance)


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n_shingles, set_key, bands, sig of every row."""

    def run(batches):
        claim("neardup")
        for batch in batches:
            ids, text = columns(batch, "doc_id", "text")
            data, offsets = buffers(text)
            n, key, bands, sig = [], [], [], []
            for s in shingle_sets(data, offsets, shingle):
                n.append(len(s))
                if not len(s):
                    key.append(None), bands.append(None), sig.append(None)
                    continue
                m = minima(s)
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(band_keys(m))
                sig.append(packed(m))
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands", "sig"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, bands array<long>, sig array<long>")


def confirm(ids, sets, sigs, split: int, percent: int, floor: float):
    """Spanning edges (id, id) of the confirmed links.

    With ``split`` > 0 only pairs across ``[:split]`` and ``[split:]`` count
    (the two blocks' own pairs belong to other tasks).  Intersections of one
    set with many are counted in one pass: its shingles are flagged and the
    flags summed over the other sets."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets])
    vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    flag = np.zeros(len(vocabulary), bool)
    group = np.arange(n)
    edges = []
    for i in range(split or n - 1):
        lo = split or i + 1
        other = lo + np.flatnonzero(group[lo:] != group[i])
        small, large = np.minimum(sizes[other], sizes[i]), np.maximum(sizes[other], sizes[i])
        other = other[100 * small >= percent * large]
        if len(other):
            other = other[estimate(sigs[i], sigs[other]) >= floor]
        if not len(other):
            continue
        flag[parts[i]] = True
        starts = np.cumsum(sizes[other]) - sizes[other]
        both = np.add.reduceat(flag[np.concatenate([parts[j] for j in other])], starts, dtype=np.int64)
        flag[parts[i]] = False
        for j in other[100 * both >= percent * (sizes[i] + sizes[other] - both)].tolist():
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                edges.append((ids[i], ids[j]))
    return edges


def _likely(sigs: np.ndarray, sizes: np.ndarray, i, j, percent: int, floor: float) -> np.ndarray:
    """Flags of the pairs (i, j) whose sizes allow a link and whose estimate reaches ``floor``."""
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    return (100 * small >= percent * large) & (estimate(sigs[i], sigs[j]) >= floor)


def spanning_pairs(key: np.ndarray, across: np.ndarray, sigs: np.ndarray, sizes: np.ndarray, percent: int, floor: float, few: int = 8):
    """(i, j) pairs that connect what the likely pairs within each run of equal
    ``key`` connect.  Where ``across`` tells two sides apart (0, 1; -1: one side
    only), pairs of one side belong to other tasks."""
    edge = np.concatenate([[True], key[1:] != key[:-1], [True]]) if len(key) else np.ones(1, bool)
    begin = np.flatnonzero(edge)
    length = np.diff(begin)
    run = np.repeat(np.arange(len(length)), length)
    left, right = [], []
    small = length[run] <= few if len(key) else np.zeros(0, bool)
    for d in range(1, few):  # short runs: every pair, all runs at once
        i = np.flatnonzero(small[:-d] & (run[:-d] == run[d:])) if len(key) > d else np.zeros(0, np.int64)
        i = i[(across[i] < 0) | (across[i] != across[i + d])]
        if len(i):
            i = i[_likely(sigs, sizes, i, i + d, percent, floor)]
            left.append(i)
            right.append(i + d)
    for a, n in zip(begin[:-1][length > few].tolist(), length[length > few].tolist()):
        group = np.arange(n)
        two = across[a] >= 0
        for k in range(n - 1):
            other = k + 1 + np.flatnonzero(group[k + 1:] != group[k])
            if two:
                other = other[across[a + other] != across[a + k]]
            if len(other):
                other = other[_likely(sigs, sizes, a + k, a + other, percent, floor)]
            for j in other.tolist():
                if group[j] != group[k]:
                    group[group == group[j]] = group[k]
                    left.append(np.array([a + k]))
                    right.append(np.array([a + j]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def candidate_pairs(reps: DataFrame, percent: int = 80, floor: float = FLOOR, hot_band: int = HOT_BAND) -> DataFrame:
    """Distinct pairs (a, b) of representatives that share a band and whose
    packed signatures are alike; per band only enough of them to connect its members."""
    members = reps.select("rep", F.explode("bands").alias("band"))
    # Written, so a band of very many members is a join that AQE can split.
    bands = keep(members.groupBy("band").agg(F.count("*").alias("c")).where("c > 1"), "neardup-bands")
    shared = members.join(bands, "band")
    blocks = F.ceil(F.col("c") / hot_band).cast("int")
    dealt = shared.select("rep", "band", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("mine")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("rep", "band", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine")
    rows = dealt.join(reps.select("rep", "n_shingles", "sig"), "rep")
    order = ("band", "lo", "hi")

    def compare(batches):
        claim("neardup")
        held = None

        def done(rows: pa.Table):
            band, lo, hi, mine, rep, size = (rows[c].combine_chunks().to_numpy() for c in (*order, "mine", "rep", "n_shingles"))
            with np.errstate(over="ignore"):
                key = mix64(band.view(np.uint64)) + lo.astype(np.uint64) * _BAND[0] + hi.astype(np.uint64) * _BAND[1]
            sig = rows["sig"].combine_chunks().flatten().to_numpy().reshape(-1, 4)
            i, j = spanning_pairs(key, np.where(lo == hi, -1, (mine == hi).astype(np.int64)), sig, size, percent, floor)
            pairs = np.unique(np.stack([np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            now = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            # the last run may go on in the next batch: it waits (a run is bounded by two blocks)
            keys = [now[c].to_numpy() for c in order]
            cut = int(np.argmax(np.logical_and.reduce([k == k[-1] for k in keys]))) if now.num_rows else 0
            if cut:
                yield done(now.slice(0, cut))
            held = now.slice(cut)
        if held is not None and held.num_rows:
            yield done(held)

    return rows.repartition(*order).sortWithinPartitions(*order, "mine", "rep").select(*order, "mine", "rep", "n_shingles", "sig") \
        .mapInArrow(compare, "a long, b long")


def candidate_groups(reps: DataFrame, percent: int = 80, floor: float = FLOOR, hot_band: int = HOT_BAND) -> DataFrame:
    """(node, component) of representatives in a candidate pair."""
    return keep(components(candidate_pairs(reps, percent, floor, hot_band)), "neardup-groups")


def distinct_sets(sigs: DataFrame) -> DataFrame:
    """One row per distinct set: set_key, rep (its smallest id), n_shingles, bands, sig."""
    usable = sigs.where("doc_id is not null and set_key is not null")
    return keep(usable.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "sig")).alias("r"))
                .select("set_key", "r.*").withColumnRenamed("doc_id", "rep"), "neardup-reps")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, floor: float = FLOOR,
                    block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES, hot_band: int = HOT_BAND) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept."""
    spark = tuned(docs.sparkSession)
    sigs = keep(signatures(docs, shingle), "neardup-sig")
    usable = sigs.where("doc_id is not null and set_key is not null")
    # Rows of one id may hold several sets; the id then stands for all of
    # them, so its representatives are linked below.
    reps = distinct_sets(sigs)
    # A written table, so a set held by very many rows is a join that AQE can split.
    classes = reps.select("set_key", "rep")
    grouped = candidate_groups(reps, percent, floor, hot_band)
    size = grouped.join(reps.select(F.col("rep").alias("node"), "n_shingles"), "node").groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("n_shingles") / block_shingles)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = grouped.join(size, "component").withColumn("mine", mine).select(
        F.col("node").alias("doc_id"), "component", "mine",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("doc_id", F.col("component").alias("grp"), F.least("mine", "other").alias("lo"),
                         F.greatest("mine", "other").alias("hi"), "mine")

    def task(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        claim("neardup")
        rows = rows.drop_duplicates(["doc_id", "text"]).sort_values(["mine", "doc_id"], kind="stable")
        data, offsets = buffers(pa.array(rows["text"], pa.large_string()))
        sets = list(shingle_sets(data, offsets, shingle))
        ids = rows["doc_id"].tolist()
        full = [k for k, s in enumerate(sets) if len(s)]
        ids, sets, mine_ = [ids[k] for k in full], [sets[k] for k in full], rows["mine"].to_numpy()[full]
        if len(ids) < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sig = np.stack([packed(minima(s)) for s in sets])
        split = int((mine_ == key[1]).sum()) if key[1] != key[2] else 0
        return pd.DataFrame(confirm(ids, sets, sig, split, percent, floor), columns=["a", "b"], dtype="int64")

    text = docs.select("doc_id", "text")
    links = dealt.join(text, "doc_id").select("grp", "lo", "hi", "mine", "doc_id", "text") \
        .groupBy("grp", "lo", "hi").applyInPandas(task, "a long, b long")
    same_id = usable.join(classes, "set_key").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    repeated = usable.groupBy("doc_id").agg(F.countDistinct("set_key").alias("n")).where("n > 1").select(F.col("doc_id").alias("a"))
    links = links.unionByName(same_id.join(repeated, "a", "left_semi"))
    comp = components(links)
    named = sigs.join(classes, "set_key", "left").withColumn("node", F.coalesce("rep", "doc_id")) \
        .join(comp, "node", "left")
    own = F.coalesce("component", "node")
    return named.select("doc_id", "n_shingles", own.alias("component_id"),
                        F.when(F.col("doc_id").isNull(), F.lit(True)).otherwise(F.col("doc_id") == own).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that lead their component (its smallest id), all
    columns unchanged; of equal rows of one id (same text) one stays, the one
    with the smallest hash of all its columns, whatever the layout.  Rows
    with a null doc_id stay."""
    gone = near_duplicates(docs, shingle, percent).where("not kept").select("doc_id")
    same = fresh("_same", docs.columns)
    named = docs.where("doc_id is not null").select("*", F.xxhash64("text").alias(same))
    lead = named.join(gone, "doc_id", "left_anti")
    hashed = [F.to_json(F.col(f"`{f.name}`")) if f.dataType.simpleString().startswith(("map", "variant")) else F.col(f"`{f.name}`")
              for f in docs.schema.fields]
    row = F.struct(F.xxhash64(*hashed).alias("order"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    # min_by keeps whole rows without comparing their columns
    one = lead.groupBy("doc_id", same).agg(F.min_by(row["row"], row["order"]).alias(same + "row"))
    return one.select(f"{same}row.*").unionByName(docs.where("doc_id is null"))
