"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected on a few random orthonormal axes, shifted by a random vector, and put in order along a
Hilbert curve; several such orderings are kept. Each ordering is cut at sampled keys into ranges, Spark deals
the ranges out, and a query meets the vectors of its own and the neighbouring ranges. The nearest of each range
are merged over all ranges and orderings and ranked by exact distance on the original vectors.

Equal vectors are one entry that carries its smallest ids, so copies add no work and no range is filled by one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.session import materialise

#: Orderings, axes of each, bits an axis.
ORDERINGS, AXES, BITS = 9, 4, 15
#: Ranges on each side of its own that a query meets, as a share of an ordering. Vectors without cluster structure
#: need a share of all vectors, not a number of them, for a constant recall.
REACH = 0.1
#: Vectors in a range, and the fewest ranges of an ordering.
RANGE_ROWS, LEAST_RANGES = 2048, 40
#: Entries from whose keys and spread the cuts, shifts and scales are fitted.
SAMPLE_ROWS = 20_000


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of integer cells (rows of axes), for all rows at once."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(len(x)):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(high, low, swap)
            if i:
                x[i] = x[i] ^ swap
        bit >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn, bit = np.zeros_like(x[0]), 1 << (bits - 1)
    while bit > 1:
        turn = np.where(x[-1] & bit, turn ^ (bit - 1), turn)
        bit >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> b) & 1)
    return key


class Orderings:
    """Seeded projections and shifts with the cuts fitted on a sample: the ranges of any vector in every ordering."""

    def __init__(self, sample: np.ndarray, ranges: int, seed: int, orderings: int, axes: int, bits: int):
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        axes = min(axes, size)
        self.bits, self.parts = bits, []
        for _ in range(orderings):
            basis = np.linalg.qr(rng.normal(size=(size, size)))[0][:, :axes]
            placed = sample @ basis
            width = np.ptp(placed, axis=0)
            width[width == 0] = 1.0
            part = [basis, placed.min(0) - rng.random(axes) * width / 2 - width / 4, width * 2]
            keys = np.sort(self._keys(sample, *part))
            cuts = keys[(np.arange(1, ranges) * len(keys)) // ranges]
            self.parts.append((*part, cuts))

    def _keys(self, x: np.ndarray, basis, low, width) -> np.ndarray:
        cells = np.floor((x @ basis - low) / width * (1 << self.bits))
        return hilbert_keys(np.clip(cells, 0, (1 << self.bits) - 1).astype(np.int64), self.bits)

    def ranges(self, x: np.ndarray) -> np.ndarray:
        """A row for each vector, a column for each ordering."""
        return np.stack([np.searchsorted(cuts, self._keys(x, *part), side="right") for *part, cuts in self.parts], 1)


def usable(vector: Column, size: int) -> Column:
    """Vectors of the given length with finite components, not all zero."""
    return (F.size(vector) == size) & ~F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) \
        & F.exists(vector, lambda v: v != 0)


def _nearest(queries: np.ndarray, rows: np.ndarray, first_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, row number and exact distance of each query's ``k`` nearest rows, ties to the smaller id."""
    rough = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None] - 2 * queries @ rows.T
    n = min(k, len(rows))
    limit = np.partition(rough, n - 1, axis=1)[:, n - 1]
    # Everything within rounding of the k-th stays until the exact distance decides.
    q, r = np.nonzero(rough <= (limit + 1e-9 * (1 + np.abs(limit)))[:, None])
    exact = np.sqrt(((queries[q] - rows[r]) ** 2).sum(1))
    order = np.lexsort((first_id[r], exact, q))
    q, r, exact = q[order], r[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], r[place < k], exact[place < k]


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           reach: float = REACH, orderings: int = ORDERINGS, axes: int = AXES, bits: int = BITS,
           range_rows: int = RANGE_ROWS, seed: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found to each query among all other rows.

    The length of vectors is the most frequent one (ties to the longer). Vectors that are null, zero, of another length
    or hold null or non-finite components, and rows with a null id, take no part. Rows that repeat an id and vector
    are candidates once. Fewer than ``k`` candidates give fewer rows; an empty table gives none.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asked")).where("id is not null and v is not null")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    size = sizes["n"] if sizes else 0
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if size < 1:
        return empty
    # -0.0 and 0.0 are equal components.
    rows = rows.where(usable(F.col("v"), size)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    rows = rows.groupBy("id", "v").agg(F.max("asked").alias("asked"))
    # The k+1 smallest ids of equal vectors (the query itself may be one); ranks prune in each task before the shuffle.
    by_vector = Window.partitionBy("v").orderBy("id")
    entries = materialise(rows.withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= k + 1)
                          .groupBy("v").agg(F.min("id").alias("entry"), F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    asked = materialise(rows.where("asked").join(entries.select("v", "entry"), "v").select("id", "entry"), "asked")
    n = entries.count()
    if not n:
        return empty
    share = min(1.0, SAMPLE_ROWS / n)
    sample = entries.where(F.pmod(F.xxhash64(F.lit(seed), "entry"), F.lit(1 << 20)) < int(share * (1 << 20))).select("v").limit(2 * SAMPLE_ROWS)
    fitted = np.array([r.v for r in sample.toLocalIterator()], float).reshape(-1, size)
    if not len(fitted):
        fitted = np.zeros((1, size))
    # Few vectors have few ranges, so that a window holds more than k of them.
    ranges = max(1, min(LEAST_RANGES, n // (4 * k + 4)), -(-n // range_rows))
    curves = Orderings(fitted, ranges, seed, orderings, axes, bits)
    side = max(1, int(np.ceil(reach * ranges)))
    # Queries of ``group`` ranges are met together, so that neither side of a meeting grows with the table.
    group = max(1, ranges // max(1, asked.count() // range_rows + 1))

    def place(frames):
        for frame in frames:
            at = curves.ranges(np.stack(frame["v"].to_numpy())) if len(frame) else np.zeros((0, orderings), np.int64)
            yield frame.assign(ranges=list(at.astype(np.int32)))

    placed = materialise(entries.select("entry", "v").mapInPandas(place, "entry long, v array<double>, ranges array<int>"), "placed")
    each = placed.select("entry", "v", F.posexplode("ranges").alias("ordering", "range"))
    # A range goes to every group of queries whose windows may touch it.
    held = each.withColumn("team", F.explode(F.expr(
        f"sequence(greatest(0, range - {side}) div {group}, least({ranges - 1}, range + {side}) div {group})")))
    asking = each.join(asked.select(F.col("entry").alias("asking")).distinct(), F.col("entry") == F.col("asking")).select(
        "asking", F.col("v").alias("q"), F.col("ordering").alias("q_ordering"), F.expr(f"range div {group}").alias("q_team"),
        F.explode(F.expr(f"sequence(greatest(0, range - {side}), least({ranges - 1}, range + {side}))")).alias("q_range"))

    def meet(left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "entry": [], "score": []}, dtype="float64")
        q, r, score = _nearest(np.stack(left["q"].to_numpy()), np.stack(right["v"].to_numpy()), right["entry"].to_numpy(), k + 1)
        return pd.DataFrame({"query": left["asking"].to_numpy()[q], "entry": right["entry"].to_numpy()[r], "score": score})

    met = asking.groupBy("q_ordering", "q_range", "q_team").cogroup(held.groupBy("ordering", "range", "team")).applyInPandas(meet, "query long, entry long, score double")
    nearest = Window.partitionBy("query").orderBy("score", "entry")
    best = met.groupBy("query", "entry").agg(F.min("score").alias("score")) \
        .withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1)
    found = asked.join(best, asked.entry == best.query).select(F.col("id").alias("query_id"), best.entry, "score") \
        .join(entries.select("entry", "ids"), "entry").select("query_id", "score", F.explode("ids").alias("vec_id")) \
        .where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_ann_curves(spark: SparkSession, sf: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return search(vectors, F.col("vec_id") % 100 == 0)
