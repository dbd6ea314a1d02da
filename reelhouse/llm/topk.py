"""Exact top-k inner products over an impact-ordered score-at-a-time index.

Components are quantised to floor(256 * x).  Rows are dealt into vector blocks
and queries into query chunks; every pair of block and chunk is one task.

In a block, the index holds for each dimension the rows by quantised impact:
the magnitude of the component in steps of ``step``.  Segments (one sign, impact
and dimension) are processed by descending impact, for a whole batch of
queries at once, adding ``query component * impact`` to the rows' accumulators.  After impact L is done, no
unprocessed component exceeds ``L * step - 1`` in magnitude and no processed
one is off by more than ``step - 1``, so accumulators bound every score to
both sides.  A query stops only when that proves a set of possible members
of its top k to be small (or when all is processed); the possible
members are then rescored exactly.  The best k of each block meet in a ranked merge.

Defined cases: null vectors, and vectors with a null or non-finite component,
take no part; vectors of different length are not compared; fewer than k
candidates give as many ranks; ties go to the smaller vec_id; rows that share
the query's vec_id are its own; equal rows of other ids all count; a
repeated query row asks once; rows with a null vec_id take no part; other
columns are ignored.  Components must stay below 2**22 in magnitude.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import tuned

K, SCALE, EVERY = 5, 256, 50
BLOCK_ROWS, CHUNK_QUERIES, BATCH, STEPS = 8192, 4096, 128, 64


class ImpactIndex:
    """Rows of one block by dimension and quantised impact."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        most = int(np.abs(rows).max(initial=0))
        self.step = max(1, -(-(most + 1) // STEPS))
        impact = np.abs(rows) // self.step
        self.top = int(impact.max(initial=0))
        self.segments: list[list[tuple[int, int, np.ndarray]]] = [[] for _ in range(self.top + 1)]
        for d in range(rows.shape[1]):
            signed = np.sign(rows[:, d]) * impact[:, d]
            order = np.argsort(signed, kind="stable")
            values = signed[order]
            edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if values[a]:
                    self.segments[abs(int(values[a]))].append((d, int(values[a]), order[a:b]))

    def top_k(self, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """(query position, row position, score) of each query's k best."""
        n = len(ids)
        wide = int(np.abs(self.rows).max(initial=0)) * int(np.abs(queries).max(initial=0)) * self.rows.shape[1] >= 1 << 30
        kind = np.int64 if wide else np.int32
        active = np.arange(len(queries))
        q = queries.astype(kind).T.copy()  # dimensions x active queries
        weight = np.abs(queries).sum(1)
        total = np.zeros((n, len(queries)), kind)
        found = []
        for level in range(self.top, -1, -1):
            for d, impact, at in self.segments[level]:
                total[at] += q[d] * kind(impact * self.step)
            # ask for a proof where the bound has shrunk by half since the last
            if level & (level - 1) and level:
                continue
            slack = weight[active] * max(self.step - 1, level * self.step - 1)
            done = np.zeros(len(active), bool)
            for c, p in enumerate(active.tolist()):
                score = total[:, c].astype(np.int64)
                score[ids == query_ids[p]] = np.iinfo(np.int64).min // 2
                least = np.partition(score, n - k)[n - k] if n > k else np.iinfo(np.int64).min // 4
                possible = np.flatnonzero(score >= max(least - 2 * slack[c], np.iinfo(np.int64).min // 4))
                if level and len(possible) > max(4 * k, n // 64):
                    continue
                done[c] = True
                exact = self.rows[possible] @ queries[p]
                best = np.lexsort((ids[possible], -exact))[:k]
                found += [(p, int(possible[i]), int(exact[i])) for i in best]
            if done.any():
                active, q, total = active[~done], q[:, ~done].copy(), np.ascontiguousarray(total[:, ~done])
                if not len(active):
                    break
        return found


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, v (array of long) of the rows that take part."""
    fit = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    rows = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fit)
    return rows.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE,
          block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible
    by ``every``, its k best among all rows of other ids."""
    tuned(vectors.sparkSession)
    rows = quantised(vectors, scale).withColumn("dim", F.size("v"))
    n, asked = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    blocks, chunks = max(1, -(-n // block_rows)), max(1, -(-asked // chunk_queries))
    # the row's place in its scan is hashed too: a row that is there very often goes to all blocks
    block = rows.select("vec_id", "v", "dim", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    chunk = rows.where(F.col("vec_id") % every == 0).distinct().select(
        "vec_id", "v", "dim", F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk"),
        F.xxhash64("v").alias("own"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def search(key: tuple, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "own": [], "vec_id": [], "score": []}
        if len(candidates) and len(queries):
            candidates = candidates.sort_values("vec_id", kind="stable")
            ids, asked = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
            own = queries["own"].to_numpy()
            index, q = ImpactIndex(np.stack(candidates["v"])), np.stack(queries["v"])
            for a in range(0, len(q), BATCH):
                for p, row, score in index.top_k(ids, asked[a:a + BATCH], q[a:a + BATCH], k):
                    if ids[row] != asked[a + p]:
                        for name, value in zip(out, (asked[a + p], own[a + p], ids[row], score)):
                            out[name].append(value)
        return pd.DataFrame(out, dtype="int64")

    found = block.groupBy("block", "chunk", "dim").cogroup(chunk.groupBy("block", "chunk", "dim")).applyInPandas(
        search, "query_id long, own long, vec_id long, score long")
    best = Window.partitionBy("query_id", "own").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
