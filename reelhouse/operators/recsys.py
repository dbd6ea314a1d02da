"""ALS recommendations: split, fit, score, evaluate, recommend, log.

The top-n is exact, also for ties, and bound-pruned.  Items are numbered by
falling factor norm and dealt into slabs of bounded size.  A slab is an index of cells, small
sets of items that lie close together, with an upper bound of a user's scores in each.  A
user meets the cells whose bound reaches the n-th best score so far, and is done
with all slabs once that score is above |user| times the largest norm still to come: no other
item can enter, not even by a tie.

Users are dealt to tasks by their id, once: slabs (of at most ``SLAB_BYTES``) are broadcast to them,
so a factor is sent once per executor and not once per opposite
block.  A task meets the slabs of a pass (1, 2, 4, ..., ``PASS_SLABS`` of them) one at a time,
``GROUP_USERS`` users with each; users that are not done are written for the next pass and not dealt anew.
Seen items are sparse bitmaps, a 64-bit word per 64 consecutive item ids of
which the user saw one, made by a partial ``bit_or``, for hot users before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.operators.joins import hot_keys
from reelhouse.session import written


@dataclass(frozen=True)
class AlsConfig:
    # Fixed values of the reference model (rank 10, 10 iterations, reg 0.1,
    # explicit feedback, cold-start rows dropped, nonnegative first model).
    rank: int = 10
    max_iter: int = 10
    reg_param: float = 0.1
    nonnegative: bool = True
    implicit_prefs: bool = False
    cold_start: str = "drop"
    seed: int = 42
    # ALS exchanges num_blocks ** 2 pieces per half step: raise it with the
    # number of ratings, not with the number of cores (None: Spark ML's default).
    num_blocks: int | None = None
    user: str = "userId"
    item: str = "movieId"
    rating: str = "rating"

    def run_id(self) -> str:
        return (f"als-rank{self.rank}-iter{self.max_iter}-reg{self.reg_param}"
                f"-nn{int(self.nonnegative)}-seed{self.seed}")


def split_ratings(df: DataFrame, keys=("userId", "movieId"), train_frac: float = 0.8,
                  seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Seeded split on the md5 of the row key's text: the same row always
    lands on the same side whatever the partitioning or the engine
    (``randomSplit`` depends on the layout).  A fact that carries its side
    (:func:`with_side`) is split by :func:`stored_split`, without the hashes."""
    side = _train_side(keys, train_frac, seed)
    return df.filter(side), df.filter(~side)


def _train_side(keys, train_frac: float, seed: int) -> Column:
    head = F.substring(F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))), 1, 8)
    return head < f"{min(int(train_frac * 2 ** 32), 2 ** 32 - 1):08x}"


SIDE = "_in_train"


def with_side(df: DataFrame, keys=("userId", "movieId"), train_frac: float = 0.8, seed: int = 42) -> DataFrame:
    """``df`` with the side of :func:`split_ratings` as a column, to be stored
    where the sides are read several times (fit, scoring, evaluation)."""
    return df.withColumn(SIDE, _train_side(keys, train_frac, seed))


def stored_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a fact that carries its side."""
    return df.filter(F.col(SIDE)).drop(SIDE), df.filter(~F.col(SIDE)).drop(SIDE)


#: Iterations between two checkpoints of a fit, and item blocks for each user block.
CHECKPOINT_EVERY, ITEM_BLOCKS = 3, 0.5


def fit_als(train: DataFrame, cfg: AlsConfig = AlsConfig()) -> ALSModel:
    """The model of ``cfg``.

    A half step sends each user to all item blocks and each item to all user blocks that rate
    it.  Spark ML draws the first user factors per user block, so their number is part of the
    model; that of the item blocks is not, and half as many halve what users send.  Spark ML
    removes the exchanged files of past iterations at a checkpoint (iterations 0, 3, 6, ...);
    without one they all stay until the model is gone."""
    als = ALS(userCol=cfg.user, itemCol=cfg.item, ratingCol=cfg.rating, rank=cfg.rank,
              maxIter=cfg.max_iter, regParam=cfg.reg_param, nonnegative=cfg.nonnegative,
              implicitPrefs=cfg.implicit_prefs, coldStartStrategy=cfg.cold_start, seed=cfg.seed,
              checkpointInterval=CHECKPOINT_EVERY)
    if cfg.num_blocks:
        als = als.setNumBlocks(cfg.num_blocks)
    als = als.setNumItemBlocks(max(1, round(als.getNumUserBlocks() * ITEM_BLOCKS)))
    return als.fit(train)


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """Root mean squared error (rows without a prediction are skipped)."""
    p = predictions.filter(F.col(prediction).isNotNull() & ~F.isnan(prediction))
    return p.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))).alias("rmse"),
                 F.count(F.lit(1)).alias("predicted"))


def flatten_recs(nested: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """``userId, recommendations[array<struct<item, rating>>]`` -> flat rows."""
    e = nested.select(user, F.explode("recommendations").alias("r"))
    return e.select(user, F.col(f"r.{item}").alias(item), F.col("r.rating").alias("prediction"))


#: Bytes of item factors of one broadcast, items of one cell, users
#: of one batch, and tasks per core that the users are dealt to.
SLAB_BYTES, BLOCK_ITEMS, BATCH_USERS, TASKS_PER_CORE = 64 << 20, 1024, 4096, 3
#: Most slabs of one pass over the users, and users that a task holds while it meets them.
PASS_SLABS, GROUP_USERS = 16, 8 * BATCH_USERS
#: Room for rounding in the bounds: scores are products in double precision
#: rounded to the model's float type.
SLACK = 1e-6


class _Best:
    """The ``n`` best (item, score) of a batch of users, by score, then item id."""

    def __init__(self, items: pa.Array, scores: pa.Array, n: int):
        m = len(items)
        self.n = n
        self.item = np.full((m, n), np.iinfo(np.int64).max)
        self.score = np.full((m, n), -np.inf, np.float32)
        held = np.arange(n) < _lengths(items)[:, None]
        self.item[held], self.score[held] = items.flatten().to_numpy(), scores.flatten().to_numpy()

    def last(self) -> np.ndarray:
        return self.score[:, -1]

    def take(self, at: np.ndarray, item: np.ndarray, got: np.ndarray) -> None:
        """Offer ``item[k]`` with the score ``got[k]`` to user ``at[k]``."""
        low = self.last()[at]
        enter = (got > low) | ((got == low) & (item < self.item[at, -1]))
        at, item, got = at[enter], item[enter], got[enter]
        if not len(at):
            return
        n, users = self.n, np.unique(at)
        who = np.concatenate([np.repeat(users, n), at])
        item = np.concatenate([self.item[users].ravel(), item])
        got = np.concatenate([self.score[users].ravel(), got])
        order = np.lexsort((item, -got, who))
        who, item, got = who[order], item[order], got[order]
        first = np.searchsorted(who, users)
        take = (first[:, None] + np.arange(n)).ravel()
        self.item[users], self.score[users] = item[take].reshape(-1, n), got[take].reshape(-1, n)

    def lists(self) -> tuple[pa.Array, pa.Array]:
        held = self.score > -np.inf
        ends = np.concatenate([[0], np.cumsum(held.sum(1))]).astype(np.int32)
        return (pa.ListArray.from_arrays(ends, pa.array(self.item[held])),
                pa.ListArray.from_arrays(ends, pa.array(self.score[held], pa.float32())))


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _matrix(features: pa.Array) -> np.ndarray:
    """Factor arrays as a matrix of doubles (null elements: NaN)."""
    return features.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(features), -1)


def _seen_items(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(user, item id) of every bit of the users' bitmap words."""
    sizes = _lengths(words)
    if not sizes.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, bits = (x.to_numpy(zero_copy_only=False) for x in words.flatten().flatten())
    at, bit = np.nonzero(np.unpackbits(bits.astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return np.repeat(np.arange(len(words)), sizes)[at], word[at].astype(np.int64) * 64 + bit


class Cells:
    """One slab of items in cells of about ``block`` items, with bounds of a user's scores in each cell.

    Factors are turned to the principal axes of the users (``moment``: mean of
    u u^T), which keeps all products.  Items are dealt into shells by falling weighted norm, each
    half of what is left, a shell into cells by halving along the axis of widest weighted spread."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, moment: np.ndarray, block: int):
        ok = np.flatnonzero(np.isfinite(v).all(1))  # others have no score
        values, self.axes = np.linalg.eigh(moment)
        w = v[ok] @ self.axes
        typical, spread = np.sqrt(np.maximum(values, 0)), np.sqrt((w * w).mean(0)) if len(w) else np.ones(v.shape[1])
        floor = 1e-3
        self.scale = np.sqrt(np.maximum(typical, floor * typical.max() + 1e-30) / np.maximum(spread, floor * spread.max() + 1e-30))
        scaled, weighed = w * self.scale, w * typical
        order = np.argsort(-(scaled * scaled).sum(1), kind="stable")
        cells, end = [], len(order)
        while end > 0:  # the inner half of what is left is a shell
            begin = end // 2 if end > 8 * block else 0
            open_ = [order[begin:end]]
            while open_:
                part = open_.pop()
                if len(part) <= block:
                    cells.append(np.sort(part))
                    continue
                x = weighed[part]
                along = x[:, np.argmax(x.max(0) - x.min(0))]
                half = np.argpartition(along, len(part) // 2)
                open_ += [part[half[:len(part) // 2]], part[half[len(part) // 2:]]]
            end = begin
        sizes = np.array([len(c) for c in cells], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        flat = np.concatenate(cells) if cells else np.zeros(0, np.int64)
        self.ids, v = ids[ok[flat]], v[ok[flat]]
        self.by_id = np.argsort(self.ids, kind="stable").astype(np.int32)
        self.sorted_ids = self.ids[self.by_id]
        self.factors = np.ascontiguousarray(v.T, np.float32)
        w, scaled = w[flat], scaled[flat]
        first = self.starts[:-1]
        if len(cells):
            self.low, self.high = np.minimum.reduceat(w, first), np.maximum.reduceat(w, first)
            self.centre = (np.minimum.reduceat(scaled, first) + np.maximum.reduceat(scaled, first)) / 2
            off = scaled - np.repeat(self.centre, sizes, axis=0)
            self.radius = np.sqrt(np.maximum.reduceat((off * off).sum(1), first))
            self.norm = np.sqrt(np.maximum.reduceat((v * v).sum(1), first))

    def positions(self, user: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(user, position in the cells) of the given items, by position; others are left out."""
        first = np.searchsorted(self.sorted_ids, item)
        at = np.flatnonzero(self.sorted_ids[np.minimum(first, len(self.sorted_ids) - 1)] == item)
        user, item, first = user[at], item[at], first[at]
        times = np.searchsorted(self.sorted_ids, item, "right") - first  # an id may come twice
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        user, position = np.repeat(user, times), self.by_id[np.repeat(first, times) + within]
        order = np.argsort(position, kind="stable")
        return user[order], position[order]

    def bounds(self, u: np.ndarray, length: np.ndarray) -> np.ndarray:
        """An upper bound of each user's scores in each cell."""
        x = u @ self.axes
        box = np.maximum(x, 0) @ self.high.T + np.minimum(x, 0) @ self.low.T
        x = x / self.scale
        ball = x @ self.centre.T + np.sqrt((x * x).sum(1))[:, None] * self.radius
        most = length[:, None] * self.norm
        room = np.sqrt((x * x).sum(1))[:, None] * (np.sqrt((self.centre ** 2).sum(1)) + self.radius)
        return np.minimum(np.minimum(box, ball), most) + SLACK * np.maximum(room, most) + 1e-30


def best_of_slab(u: np.ndarray, best: _Best, seen: tuple[np.ndarray, np.ndarray], cells: Cells, rest: float,
                 done: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offer one slab (``rest``: the largest norm after it) to those of a batch of
    users that are not ``done``.  Returns which users are done now and how many pairs each scored.

    Each user meets the cell of highest bound first, then, cell by cell, all users meet
    the cell whose bound does not rule it out.  Products in single precision find the pairs that may enter;
    these are scored in double precision, factor by factor, so equal factors give equal predictions."""
    length = np.sqrt((u * u).sum(1))
    scored = np.zeros(len(u), np.int64)
    usable = np.isfinite(length) & ~done
    if len(cells.ids) and usable.any():
        user, position = cells.positions(*seen)
        small = u.astype(np.float32)
        bound = np.full((len(u), len(cells.starts) - 1), -np.inf)
        bound[usable] = cells.bounds(u[usable], length[usable])
        rounding = length * (u.shape[1] + 4) * 2.0 ** -23
        row = np.full(len(u), -1)

        def meet(rows: np.ndarray, c: int) -> None:
            a, b = cells.starts[c], cells.starts[c + 1]
            score = small[rows] @ cells.factors[:, a:b]
            lo, hi = np.searchsorted(position, [a, b])
            if hi > lo:
                row[rows] = np.arange(len(rows))
                at = row[user[lo:hi]]
                score[at[at >= 0], position[lo:hi][at >= 0] - a] = -np.inf
                row[rows] = -1
            room = rounding[rows] * cells.norm[c] + 1e-30
            low = best.last()[rows] - room
            new = np.flatnonzero(low == -np.inf)
            if len(new) and b - a >= best.n:  # the n-th best of the cell alone is a bound too
                low[new] = np.partition(score[new], b - a - best.n, axis=1)[:, b - a - best.n] - 2 * room[new]
            hit = np.flatnonzero((score >= np.maximum(low, np.finfo(np.float32).min)[:, None]).ravel())
            scored[rows] += b - a
            if len(hit):
                at, j = rows[hit // (b - a)], a + hit % (b - a)
                exact = u[at, 0] * cells.factors[0, j]
                for r in range(1, u.shape[1]):
                    exact += u[at, r] * cells.factors[r, j]
                best.take(at, cells.ids[j], exact.astype(np.float32))

        def in_cells(cell: np.ndarray, rows: np.ndarray) -> None:
            rows = rows[np.argsort(cell[rows], kind="stable")]
            for part in np.split(rows, np.flatnonzero(np.diff(cell[rows])) + 1):
                meet(part, cell[part[0]])
                bound[part, cell[part[0]]] = -np.inf

        in_cells(bound.argmax(1), np.flatnonzero(usable))
        for c in np.argsort(-bound.max(0), kind="stable"):
            rows = np.flatnonzero((bound[:, c] >= best.last()) & (bound[:, c] > -np.inf))
            if len(rows):
                meet(rows, c)
    done = ~usable
    if rest >= 0:
        done |= best.last() > length * rest * (1 + SLACK) + 1e-30
    else:
        done[:] = True
    return done, scored


def _slabs(item_factors: DataFrame, slab_items: int) -> DataFrame:
    """Items numbered by falling norm (at), sorted and written once: i, features, norm, at, slab.

    The number is the place inside its range partition behind the rows of all earlier ones."""
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = item_factors.select(F.col("id").alias("i"), "features", norm.alias("norm")).orderBy(F.col("norm").desc(), "i")
    rows = written(rows.select("*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("mid")), "item_slabs")
    held = {r["pid"]: r["count"] for r in rows.groupBy("pid").count().collect()}
    before = np.concatenate([[0], np.cumsum([held.get(p, 0) for p in range(max(held, default=0))])]).astype(int)
    at = F.element_at(F.array(*(F.lit(int(x)).cast("long") for x in before)), F.col("pid") + 1) + F.col("mid") - F.shiftleft(F.col("pid").cast("long"), 33)
    return rows.select("i", "features", "norm", at.alias("at")).withColumn("slab", F.expr(f"int(at div {slab_items})"))


def _moment(user_factors: DataFrame, rank: int) -> np.ndarray:
    """Mean of u u^T over the users."""
    at = [(a, b) for a in range(rank) for b in range(a + 1)]
    part = [F.avg(F.col("features")[a].cast("double") * F.col("features")[b]) for a, b in at]
    out = np.zeros((rank, rank))
    for (a, b), x in zip(at, user_factors.agg(*part).first()):
        out[a, b] = out[b, a] = x if x is not None and np.isfinite(x) else 0.0
    return out


def _bitmaps(seen: DataFrame, tasks: int) -> DataFrame:
    """(u, seen): a user's seen items as sparse bitmap words, dealt to ``tasks`` tasks by user.

    Pairs are shuffled once, as they are; only those of hot users (``seen`` is read for their
    counts first) become words before.  Words of other users hold hardly more than one item each."""
    pairs = seen.where("u is not null and i is not null").select("u", F.col("i").cast("long").alias("i"))
    hot = hot_keys(pairs, "u")
    bit, word = F.expr("shiftleft(1L, cast(i & 63 as int))"), F.shiftright("i", 6)
    many = pairs.join(F.broadcast(hot), "u", "left_semi").groupBy("u", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    few = pairs.join(F.broadcast(hot), "u", "left_anti").withColumn("bits", F.lit(None).cast("long"))
    dealt = few.unionByName(many.select("u", F.shiftleft("word", 6).alias("i"), "bits")).repartition(tasks, "u")
    words = dealt.groupBy("u", word.alias("word")).agg(F.bit_or(F.coalesce("bits", bit)).alias("bits"))
    return words.groupBy("u").agg(F.collect_list(F.struct("word", "bits")).alias("seen"))


_SEEN = pa.list_(pa.struct([("word", pa.int64()), ("bits", pa.int64())]))


def _offered(users: pa.Table, slabs: list, n: int) -> list[pa.RecordBatch]:
    """A group of users after the slabs of one pass; a user that is done keeps its lists only."""
    parts = [users.slice(a, BATCH_USERS).combine_chunks() for a in range(0, users.num_rows, BATCH_USERS)]
    parts = [{c: p[c].chunk(0) for c in p.column_names} for p in parts]
    factors = [_matrix(p["features"]) for p in parts]
    best = [_Best(p["item"], p["score"], n) for p in parts]
    seen = [_seen_items(p["seen"]) for p in parts]
    scored = [p["scored"].to_numpy().copy() for p in parts]
    done = [np.zeros(len(x), bool) for x in scored]
    for shared, rest in slabs:
        cells = shared.value
        for k in range(len(parts)):
            if not done[k].all():
                done[k], more = best_of_slab(factors[k], best[k], seen[k], cells, rest, done[k])
                scored[k] += more
        del cells
        if len(slabs) > 1:  # a worker would keep every slab it met
            vars(shared).pop("_value", None)
    out = []
    for k, p in enumerate(parts):
        item, score = best[k].lists()
        at = pa.RecordBatch.from_arrays(
            [p["u"].cast(pa.int32()), p["features"].cast(pa.list_(pa.float32())), item, score, pa.array(scored[k]), p["seen"].cast(_SEEN), pa.array(done[k])],
            ["u", "features", "item", "score", "scored", "seen", "done"])
        ready = at.filter(at["done"])
        for c in ("features", "seen"):
            j = ready.schema.get_field_index(c)
            ready = ready.set_column(j, c, pa.nulls(ready.num_rows, ready.schema.field(j).type))
        out += [x for x in (ready, at.filter(pc.invert(at["done"]))) if x.num_rows]
    return out


def pruned_top_n(user_factors: DataFrame, item_factors: DataFrame, seen: DataFrame | None, n: int,
                 slab_bytes: int = SLAB_BYTES, block: int = BLOCK_ITEMS, wanted: DataFrame | None = None) -> DataFrame:
    """Exact top ``n`` per user: (u, item array, score array, scored).

    Factors are (id, features); ``seen`` (u, i) pairs are left out (read three times: pass a stored table);
    ``wanted`` (id) limits the users.
    Lists go by score, then item id; ``scored`` counts the pairs that were multiplied for the user."""
    spark = user_factors.sparkSession
    rank = item_factors.select(F.coalesce(F.max(F.size("features")), F.lit(1))).first()[0]
    slabs = _slabs(item_factors, max(64, slab_bytes // (4 * rank + 16) // 64 * 64))
    tops = {r["slab"]: r["norm"] for r in slabs.groupBy("slab").agg(F.max("norm").alias("norm")).collect()}
    # The work of a row is much more than its bytes: sizes must not decide the number of tasks.
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    state = user_factors.select(F.col("id").alias("u"), "features").repartition(tasks, "u")
    if wanted is not None:
        state = state.join(wanted.select(F.col("id").alias("u")), "u", "left_semi")
    none, words = F.array(), "array<struct<word:bigint,bits:bigint>>"
    if seen is None:
        state = state.withColumn("seen", F.lit(None).cast(words))
    else:
        state = state.join(_bitmaps(seen, tasks), "u", "left")
    state = state.select("u", "features", none.cast("array<long>").alias("item"), none.cast("array<float>").alias("score"),
                         F.lit(0).cast("long").alias("scored"), F.col("seen").cast(words).alias("seen"))
    schema = f"u int, features array<float>, item array<long>, score array<float>, scored long, seen {words}, done boolean"
    if not tops:
        return state.select("u", "item", "score", "scored")
    moment, done, start, many = _moment(user_factors, rank), None, 0, 1
    while True:
        met = []
        for slab in range(start, min(start + many, len(tops))):
            rows = slabs.where(F.col("slab") == slab).select("i", "features", "at").toArrow().sort_by("at")
            shared = spark.sparkContext.broadcast(Cells(rows["i"].to_numpy().astype(np.int64), _matrix(rows["features"].combine_chunks()), moment, block))
            met.append((shared, -1.0 if slab + 1 not in tops else np.inf if tops[slab + 1] is None else tops[slab + 1]))

        def offer(batches, met=met):
            held = []
            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= GROUP_USERS:
                    yield from _offered(pa.Table.from_batches(held), met, n)
                    held = []
            if held:
                yield from _offered(pa.Table.from_batches(held), met, n)

        state = state.mapInArrow(offer, schema)
        start, many = start + len(met), min(2 * many, PASS_SLABS)
        if start < len(tops):
            state = written(state, "top_n")
        ready = state.where("done")
        done = ready if done is None else done.unionByName(ready)
        if start == len(tops):
            break
        state = state.where("not done").drop("done")
        if state.isEmpty():
            break
    return done.select("u", "item", "score", "scored")


def recommend(model: ALSModel, ratings: DataFrame, n: int = 10, exclude_seen: bool = True,
              users: DataFrame | None = None, user: str = "userId", item: str = "movieId",
              rank_col: str | None = "rank", slab_bytes: int = SLAB_BYTES, block: int = BLOCK_ITEMS) -> DataFrame:
    """Top ``n`` items per user, ``(user, item, prediction[, rank])``, ordered
    by prediction, then item id.

    ``exclude_seen`` leaves out items the user rated.  ``users`` limits the
    users (default: every user of ``ratings``); users unknown to the model get
    no rows (cold start)."""
    seen = ratings.select(F.col(user).alias("u"), F.col(item).alias("i"))
    wanted = (seen.select(F.col("u").alias("id")) if users is None else users.select(F.col(user).alias("id"))).distinct()
    best = pruned_top_n(model.userFactors, model.itemFactors, seen if exclude_seen else None, n, slab_bytes, block, wanted)
    rows = best.select(F.col("u").alias(user), F.posexplode(F.arrays_zip("item", "score")))
    out = [F.col(user), F.col("col.item").cast("int").alias(item), F.col("col.score").alias("prediction")]
    return rows.select(*out, *([(F.col("pos") + 1).alias(rank_col)] if rank_col else []))


def recommend_nested(model: ALSModel, n: int = 10, users: DataFrame | None = None, user: str = "userId", item: str = "movieId",
                     slab_bytes: int = SLAB_BYTES, block: int = BLOCK_ITEMS) -> DataFrame:
    """``(user, recommendations[array<struct<item, rating>>])``, the rows of
    ``ALSModel.recommendForAllUsers`` (with ``users``: of ``recommendForUserSubset``).

    Spark ML scores all pairs and shuffles ``n`` rows per user and block of 4,096
    items; this is the bound-pruned search of :func:`recommend`, ties to the smaller item id."""
    wanted = None if users is None else users.select(F.col(user).alias("id")).distinct()
    best = pruned_top_n(model.userFactors, model.itemFactors, None, n, slab_bytes, block, wanted)
    one = lambda i, s: F.struct(i.cast("int").alias(item), s.alias("rating"))
    return best.select(F.col("u").alias(user), F.zip_with("item", "score", one).alias("recommendations")).where("size(recommendations) > 0")


def run_metrics(cfg: AlsConfig, rmse_df: DataFrame) -> DataFrame:
    """One-row run log: the configuration used and the evaluated RMSE."""
    return rmse_df.select(F.lit(cfg.run_id()).alias("run_id"), F.lit(cfg.rank).alias("rank"),
                          F.lit(cfg.max_iter).alias("maxIter"), F.lit(float(cfg.reg_param)).alias("regParam"),
                          F.lit(cfg.nonnegative).alias("nonnegative"), F.col("rmse"))


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)
