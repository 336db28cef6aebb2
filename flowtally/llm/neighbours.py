"""Approximate nearest neighbours by cosine over shifted Hilbert curves.

Vectors are projected to ``AXES`` dimensions in ``CURVES`` random ways, each
with a random shift, and ordered along a Hilbert curve through the projected
cells.  Spark range-partitions every ordering, which gives each vector its
rank.  A query's candidates are the vectors whose rank on some curve is within
the window of its own; they are compared exactly and the best of all windows
are merged.

The window's width is measured, not set: for ``CALIBRATION`` queries the true
neighbours are found by brute force, and the width is the ``RECALL`` quantile
of how far from the query they rank on their best curve.  Vectors in clusters
need narrow windows; vectors spread evenly over many dimensions need windows
that grow with the table.

Equal vectors are one point of the orderings, with the smallest ids that a
result can need, so a vector with many copies costs no more than another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtally.llm.common import share_hash, store

CURVES = 8
AXES = 8
BITS = 7                    # of each axis: 56 bits a key
FIT_ROWS = 4_096            # vectors that set the cells of the axes
CALIBRATION = 256           # queries that set the window
RECALL = 0.96
QUERY_CHUNK = 4_096         # queries that meet one block of candidates at a time
SEED = 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of integer points (n x axes), by
    Skilling's transposition."""
    x = cells.astype(np.uint64)
    n, axes = x.shape
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:
        low = q - one
        for i in range(axes):
            hit = (x[:, i] & q) != 0
            swap = np.where(hit, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(hit, low, swap)
            x[:, i] ^= swap
        q >>= one
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, dtype=np.uint64)
    q = one << np.uint64(bits - 1)
    while q > one:
        flip ^= np.where((x[:, axes - 1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    x ^= flip[:, None]
    key = np.zeros(n, dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << one) | ((x[:, i] >> np.uint64(b)) & one)
    return key


class Curves:
    """Projections, shifts and cell bounds for vectors of one dimension."""

    def __init__(self, sample: np.ndarray, dimension: int):
        rng = np.random.default_rng([SEED, dimension])
        self.axes = min(AXES, dimension)
        self.project = [np.linalg.qr(rng.standard_normal((dimension, self.axes)))[0]
                        for _ in range(CURVES)]
        self.shift = rng.uniform(0, 0.2, (CURVES, self.axes))
        # Cells hold equal shares of the sample along every axis.
        self.knots = [np.sort(sample @ p, axis=0) for p in self.project]

    def keys(self, unit: np.ndarray, curve: int) -> np.ndarray:
        y, knots = unit @ self.project[curve], self.knots[curve]
        place = np.stack([np.interp(y[:, i], knots[:, i], np.linspace(0, 1, len(knots)))
                          if len(knots) > 1 else np.full(len(y), 0.5)
                          for i in range(self.axes)], axis=1)
        cells = np.minimum((place * 0.8 + self.shift[curve]) * (1 << BITS), (1 << BITS) - 1)
        return hilbert_keys(cells.astype(np.uint64), BITS).astype(np.int64)


SALTS = 64


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _units(m: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large and very small values square safely.
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def valid_vectors(table: DataFrame) -> DataFrame:
    """vec_id and v (array of double) of the rows that take part."""
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(
        ~bad & F.exists("v", lambda x: x != 0))


def distinct_points(rows: DataFrame, keep: int, query_every: int) -> DataFrame:
    """rep (smallest id), v, ids (the ``keep`` smallest, repeats included),
    is_query and dim of every distinct vector.

    Of a vector's rows only the ``keep`` smallest ids of each salt, among
    queries and among others, go on: rows are numbered, and what is beyond is
    dropped before it is shuffled, so that no group grows with the table.
    """
    salted = rows.withColumns({"salt": share_hash("vec_id", buckets=SALTS),
                               "is_query": F.col("vec_id") % query_every == 0})
    order = Window.partitionBy("v", "salt", "is_query").orderBy("vec_id")
    few = salted.withColumn("number", F.row_number().over(order)).filter(F.col("number") <= keep)
    return (few.groupBy("v").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, keep).alias("ids"),
                                 F.max("is_query").alias("is_query"))
            .select(F.col("ids")[0].alias("rep"), "v", "ids", "is_query", F.size("v").alias("dim")))


def _best(batches: Iterator[pd.DataFrame], queries: dict, k: int) -> Iterator[pd.DataFrame]:
    """For every query the k best points of each batch."""
    for batch in batches:
        for dim, part in batch.groupby("dim"):
            if dim not in queries:
                continue
            ids, own = queries[dim]
            yield _top(ids, own, part["rep"].to_numpy(), _units(_matrix(part["v"])), k)


def _top(query_ids, queries, reps, units, k) -> pd.DataFrame:
    """The k largest cosines of each query, equal ones by the smaller rep."""
    order = np.argsort(reps, kind="stable")
    reps, units = reps[order], units[order]
    out_q, out_r, out_c = [], [], []
    for at in range(0, len(query_ids), 512):
        cosines = queries[at:at + 512] @ units.T
        # Cut at the k-th value, ties included, then order these few.
        if cosines.shape[1] > k:
            kth = np.partition(cosines, -k, axis=1)[:, -k] - 1e-12
        else:
            kth = np.full(len(cosines), -np.inf)
        for i, row in enumerate(cosines):
            near = np.flatnonzero(row >= kth[i])
            near = near[np.lexsort((reps[near], -np.round(row[near], 12)))][:k]
            out_q += [query_ids[at + i]] * len(near)
            out_r.append(reps[near])
            out_c.append(row[near])
    if not out_q:
        return pd.DataFrame({"query": [], "rep": [], "cosine": []}).astype(
            {"query": "int64", "rep": "int64", "cosine": "float64"})
    return pd.DataFrame({"query": np.array(out_q, dtype=np.int64), "rep": np.concatenate(out_r),
                         "cosine": np.concatenate(out_c)})


FOUND = "query long, rep long, cosine double"


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best points of each query, each once."""
    once = found.groupBy("query", "rep").agg(F.max("cosine").alias("cosine"))
    order = Window.partitionBy("query").orderBy(F.desc(F.round("cosine", 12)), "rep")
    return once.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r")


def brute_force(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, rep, cosine) of the k best points for a few queries, which are
    sent to every task; at most ``CALIBRATION`` rows are meant."""
    few: dict = {}
    for r in queries.select("rep", "v", "dim").collect():
        few.setdefault(r.dim, ([], []))
        few[r.dim][0].append(r.rep)
        few[r.dim][1].append(list(r.v))
    few = {d: (np.array(i), _units(np.array(v, dtype=np.float64))) for d, (i, v) in few.items()}
    shared = points.sparkSession.sparkContext.broadcast(few)
    found = points.select("rep", "v", "dim").mapInPandas(
        lambda batches: _best(batches, shared.value, k), FOUND)
    return _merged(found, k)


def fit_curves(points: DataFrame) -> dict[int, Curves]:
    """Curves by dimension, cells set by about ``FIT_ROWS`` vectors."""
    n = points.count()
    rate = min(1.0, FIT_ROWS / n) if n else 0.0
    sample: dict[int, list] = {r.dim: [] for r in points.select("dim").distinct().collect()}
    for r in (points.filter(share_hash("rep", seed=5) < int(rate * 1_000_000))
              .orderBy("rep").select("dim", "v").collect()):
        sample[r.dim].append(list(r.v))
    return {d: Curves(_units(np.array(v, dtype=np.float64)) if v else np.zeros((0, d)), d)
            for d, v in sample.items()}


def ranked_points(points: DataFrame, curves: dict[int, Curves]) -> DataFrame:
    """rep, dim, curve, rank, v and is_query, every point once per curve;
    ranks run through all orderings, in order of (dim, curve, key, rep)."""
    shared = points.sparkSession.sparkContext.broadcast(curves)
    schema = "rep long, dim int, is_query boolean, v array<double>, curve int, key long"

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                units = _units(_matrix(part["v"]))
                for c in range(CURVES):
                    yield part.assign(curve=c, key=shared.value[dim].keys(units, c))

    rows = points.select("rep", "dim", "is_query", "v").mapInPandas(keyed, schema)
    # Within a partition of the range partitioning, rows are numbered by
    # monotonically_increasing_id: the partition above, the row below 2^33.
    dealt = (rows.repartitionByRange("dim", "curve", "key", "rep")
             .sortWithinPartitions("dim", "curve", "key", "rep")
             .withColumn("at", F.monotonically_increasing_id()))
    dealt = store(dealt, "curves")
    part = F.shiftright("at", 33)
    sizes = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row a partition
    base = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    low = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return (dealt.withColumn("part", part).join(base, "part")
            .select("rep", "dim", "is_query", "v", "curve", (F.col("base") + low).alias("rank")))


def measured_window(points: DataFrame, ranked: DataFrame, k: int, recall: float) -> int:
    """The half-width that holds ``recall`` of the true neighbours of the
    calibration queries."""
    queries = points.filter("is_query").orderBy(share_hash("rep", seed=9), "rep").limit(CALIBRATION)
    queries = store(queries, "calibration")
    truth = brute_force(points, queries, k + 1).filter("query <> rep").select("query", "rep")
    truth = store(truth, "truth")
    here = ranked.select("dim", "curve", "rep", "rank")
    q = here.select("dim", "curve", F.col("rep").alias("query"), F.col("rank").alias("q_rank"))
    apart = (truth.join(here, "rep").join(q, ["query", "dim", "curve"])
             .groupBy("query", "rep").agg(F.min(F.abs(F.col("rank") - F.col("q_rank"))).alias("d")))
    far = sorted(r.d for r in apart.select("d").collect())      # at most CALIBRATION * k numbers
    return int(far[min(len(far) - 1, math.floor(recall * len(far)))]) if far else 1


def search(table: DataFrame, k: int = 5, query_every: int = 50, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of every query,
    a row of ``table`` (vec_id, embedding; other columns are not read) whose
    vec_id is divisible by ``query_every``.

    Rows with a null vec_id, and vectors null, empty, zero or with null or
    non-finite components take no part.  Vectors are compared with those of
    their own dimension.  Rows that repeat are rows of their own: they are
    candidates of each other, and each query row is answered.  Ties go to the
    smaller vec_id.  A query without candidates, and an empty table, give no
    rows.
    """
    rows = valid_vectors(table)
    points = store(distinct_points(rows, k + 1, query_every), "points")
    ranked = store(ranked_points(points, fit_curves(points)), "ranks")
    total, asked = points.agg(F.count("*"), F.sum(F.col("is_query").cast("long"))).first()
    if not total or not asked:
        return table.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double")
    width = measured_window(points, ranked, k, recall)
    block = max(64, min(4096, width // 4))
    chunks = max(1, math.ceil(asked * (2 * width + 2 * block) / total / QUERY_CHUNK))
    home = F.floor(F.col("rank") / block)
    asking = (ranked.filter("is_query")
              .withColumn("block", F.explode(F.sequence(
                  F.floor((F.col("rank") - width) / block), F.floor((F.col("rank") + width) / block))))
              .select(F.col("rep").alias("query"), "dim", "curve", "v", "block",
                      share_hash("rep", buckets=chunks, seed=3).cast("int").alias("chunk")))
    offered = (ranked.select("rep", "dim", "curve", "v", home.alias("block"))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    group = ["dim", "curve", "block", "chunk"]

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return _top(np.zeros(0), np.zeros((0, 1)), np.zeros(0), np.zeros((0, 1)), k + 1)
        return _top(queries["query"].to_numpy(), _units(_matrix(queries["v"])),
                    candidates["rep"].to_numpy(), _units(_matrix(candidates["v"])), k + 1)

    found = asking.groupBy(*group).cogroup(offered.groupBy(*group)).applyInPandas(meet, FOUND)
    best = store(_merged(found, k + 1).select("query", "rep"), "nearest")
    # The cosine of the vectors as given, and the ids of each point.
    one = points.select(F.col("rep").alias("query"), F.col("v").alias("q"))
    both = best.join(one, "query").join(points.select("rep", "v", "ids"), "rep")

    def dot(a: str, b: str):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    scored = both.select("query", F.explode("ids").alias("vec_id"),
                         (dot("q", "v") / (F.sqrt(dot("q", "q")) * F.sqrt(dot("v", "v")))).alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = (scored.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
             .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
             .join(one, "query"))
    asked_rows = rows.filter(F.col("vec_id") % query_every == 0).select(
        F.col("vec_id").alias("query_id"), "v")
    answered = asked_rows.join(lists.select(F.col("q").alias("v"), "near"), "v")
    # The query's own row is one of the list, or beyond it.
    own = F.array_position(F.transform("near", lambda x: x.vec_id), F.col("query_id"))
    others = F.slice(F.filter("near", lambda x, i: i != F.col("own") - 1), 1, k)
    return (answered.withColumn("own", own).select("query_id", F.posexplode(others).alias("i", "x"))
            .select("query_id", (F.col("i") + 1).cast("int").alias("rank"),
                    F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")))
