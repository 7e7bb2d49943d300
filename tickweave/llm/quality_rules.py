"""Quality rules: base counts of a text, and robust multivariate outliers per language and source.

Statistic vectors are transformed so that clean text is roughly normal in them. For each language and source
a minimum-covariance-determinant estimate is found by concentration steps: from a start at the
coordinate-wise medians, the ``SHARE`` of vectors with the smallest Mahalanobis distance gives the next mean
and covariance, a fixed number of times. A document is rejected when its squared distance from the last
estimate exceeds ``CUT``. Everything is DataFrame and SQL work: aggregates of products give the moments,
a Cholesky factor written out as column expressions gives distances, and quantiles come from counts per
fine bin, so a group that holds a third of all rows is summed map-side like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.session import materialise

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
#: Statistic: standard deviation that is added to every estimate. Texts in which a statistic hardly varies (no symbol
#: anywhere) then have no zero variance, and differences below a few of these never make an outlier.
FLOORS = {"x_length": 0.12, "x_symbols": 0.085, "x_lines": 0.25, "x_repeats": 0.25, "x_capitals": 0.16}
STATS = list(FLOORS)
#: Share of a group's vectors that a concentration step keeps, and the number of steps.
SHARE, STEPS = 0.75, 3
#: Squared distance above which a document is an outlier: the 0.999 quantile of chi-square with 5 degrees of freedom, doubled.
CUT = 41.0
#: Bins per unit: of a statistic, and of the logarithm of a distance.
VALUE_BINS, DISTANCE_BINS = 256, 64
GROUP = ["g_lang", "g_source"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base_counts(text: Column) -> dict[str, Column]:
    """Counts of whole texts (null: no word) as Columns, in the terms of the README."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return {"word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_capitals": (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "words": words}


#: Words in 3-word windows that occur twice or more. Windows are compared as 64-bit hashes; only texts with a repeated one
#: sort them, and neighbours of equal hash mark their three words each.
_WINDOWS = "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))"
_SORTED = "array_sort(transform(windows, (x, i) -> struct(x AS x, i AS i)))"
_PLACES = ("transform(filter(transform(sequence(0, size(sorted) - 1), j -> struct(sorted[j].i AS i, "
           "(j > 0 AND sorted[greatest(j - 1, 0)].x = sorted[j].x) OR (j < size(sorted) - 1 AND "
           "sorted[least(j + 1, size(sorted) - 1)].x = sorted[j].x) AS twice)), s -> s.twice), s -> s.i)")
_COVERED = "cast(size(array_distinct(flatten(transform(places, i -> array(i, i + 1, i + 2))))) AS long)"


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and the transformed statistics; columns of these names are replaced."""
    base = base_counts(F.col(f"`{text}`"))
    words = base.pop("words")
    out = docs.withColumns(base).withColumn("words", words)
    out = out.withColumn("n_words", F.size("words").cast("long"))
    # Conditions keep texts without any repeated window out of the sort.
    out = out.withColumn("windows", F.when(F.col("n_words") >= 4, F.expr(_WINDOWS)))
    out = out.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.expr(_SORTED)))
    out = out.withColumn("places", F.when(F.col("sorted").isNotNull(), F.expr(_PLACES)))
    out = out.withColumn("n_repeat_words", F.coalesce(F.when(F.col("places").isNotNull(), F.expr(_COVERED)), F.lit(0)).cast("long"))
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return out.drop("words", "windows", "sorted", "places").withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "x_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x_symbols": F.sqrt(F.col("n_symbols") / n),
        "x_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "x_repeats": F.sqrt(F.col("n_repeat_words") / n),
        "x_capitals": F.sqrt(F.col("n_capitals") / chars)})


def _bin_quantile(bins: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Smallest ``bin`` by key with at least the share ``q`` of the rows at or below it; ``bins`` has one row per key and bin."""
    w = Window.partitionBy(*keys)
    return (bins.withColumn("run", F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("all", F.sum("n").over(w)).where(F.col("run") >= F.col("all") * q)
            .groupBy(*keys).agg(F.min("bin").alias("bin")))


def _cholesky(cov: dict[tuple[int, int], Column]) -> dict[tuple[int, int], Column]:
    """Lower factor of a covariance as expressions; the floors keep every pivot positive."""
    low: dict[tuple[int, int], Column] = {}
    for i in range(len(STATS)):
        for j in range(i + 1):
            rest = cov[i, j]
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            low[i, j] = F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}")
    return low


def _factor(moments: DataFrame) -> DataFrame:
    """``GROUP``, means ``m*`` and factor ``l**`` from group means and second moments."""
    cov = {(i, j): F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") + (F.lit(FLOORS[STATS[i]] ** 2) if i == j else F.lit(0.0))
           for i in range(len(STATS)) for j in range(i + 1)}
    # One column after the other, so that each is worked out once.
    for (i, j), value in _cholesky(cov).items():
        moments = moments.withColumn(f"l{i}{j}", value)
    return moments.select(*GROUP, *[f"m{i}" for i in range(len(STATS))],
                          *[f"l{i}{j}" for i in range(len(STATS)) for j in range(i + 1)])


def _distance(stats: DataFrame, estimate: DataFrame, how: str = "inner") -> DataFrame:
    """``stats`` with the squared Mahalanobis distance ``d2`` from its group's estimate, by forward substitution."""
    out = stats.join(estimate, GROUP, how)
    for i in range(len(STATS)):
        value = F.col(STATS[i]) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, len(STATS))), F.col("z0") * F.col("z0"))
    return out.withColumn("d2", d2).select(*stats.columns, "d2")


def _start(stats: DataFrame) -> DataFrame:
    """Coordinate-wise medians, with the floors and the spread around them as a diagonal covariance."""
    stacked = stats.select(*GROUP, F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.floor(F.col(x) * VALUE_BINS).alias("bin"))
                                                       for i, x in enumerate(STATS)])).alias("v")).select(*GROUP, "v.*")
    bins = materialise(stacked.groupBy(*GROUP, "dim", "bin").agg(F.count("*").alias("n")), "bins")
    median = _bin_quantile(bins, [*GROUP, "dim"], 0.5).withColumnRenamed("bin", "mid")
    away = bins.join(median, [*GROUP, "dim"]).groupBy(*GROUP, "dim", "mid", F.abs(F.col("bin") - F.col("mid")).alias("bin")) \
        .agg(F.sum("n").alias("n"))
    spread = _bin_quantile(away, [*GROUP, "dim", "mid"], 0.5)
    # 1.4826 times the median deviation estimates a normal's standard deviation.
    wide = spread.groupBy(*GROUP).agg(*[F.max(F.when(F.col("dim") == i, (F.col("mid") + 0.5) / VALUE_BINS)).alias(f"m{i}") for i in range(len(STATS))],
                                      *[F.max(F.when(F.col("dim") == i, F.col("bin") * 1.4826 / VALUE_BINS)).alias(f"d{i}") for i in range(len(STATS))])
    return _factor(wide.select("*", *[
        (F.col(f"m{i}") * F.col(f"m{j}") + (F.col(f"d{i}") * F.col(f"d{i}") if i == j else F.lit(0.0))).alias(f"s{i}{j}")
        for i in range(len(STATS)) for j in range(i + 1)]))


def mcd(stats: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Robust mean and covariance factor of every group of ``stats`` (columns ``GROUP`` and ``STATS``)."""
    estimate = materialise(_start(stats), "estimate")
    for _ in range(steps):
        near = _distance(stats, estimate).withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * DISTANCE_BINS))
        edge = _bin_quantile(near.groupBy(*GROUP, "bin").agg(F.count("*").alias("n")), GROUP, share).withColumnRenamed("bin", "edge")
        subset = near.join(edge, GROUP).where(F.col("bin") <= F.col("edge"))
        moments = subset.groupBy(*GROUP).agg(
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(STATS)],
            *[F.avg(F.col(STATS[i]) * F.col(STATS[j])).alias(f"s{i}{j}") for i in range(len(STATS)) for j in range(i + 1)])
        estimate = materialise(_factor(moments), "estimate")
    return estimate


def judge(docs: DataFrame, columns: list[str] | None = None, cut: float = CUT) -> DataFrame:
    """``columns`` of ``docs`` (all by default), the base counts, ``base_failed`` and ``kept``.

    A null language or source is a group of its own. Rows that fail the base rules take no part in the
    estimates and are not kept. A group of few vectors has the floors as its spread, so that hardly anything is
    rejected there. Columns with the names of the counts are replaced, other names cannot clash; repeated rows are judged alike.
    Null and empty texts fail the base rules, very long ones are judged whole, an empty table gives an empty result.
    """
    kept = [c for c in (columns or docs.columns) if c not in {*COUNTS, "kept"}]
    # Under names of their own, so that no column meets one of the many made on the way.
    own = [f"own__{i}" for i in range(len(kept))]
    given = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(kept, own, strict=True)], "text", "lang", "source")
    counted = with_statistics(given).withColumns(
        {g: F.coalesce(F.col(c), F.lit("\x00")) for g, c in zip(GROUP, ("lang", "source"), strict=True)})
    # Texts are parsed once; the steps then read the statistics alone.
    counted = materialise(counted.select(*own, *COUNTS, *GROUP, *STATS), "counted", codec="zstd")
    estimate = mcd(counted.where(~F.col("base_failed")).select(*GROUP, *STATS))
    out = _distance(counted, estimate, "left")
    # A group without estimate has base failures only.
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cut)).select(
        *[F.col(o).alias(c) for c, o in zip(kept, own, strict=True)], *COUNTS, "kept")


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id"])
