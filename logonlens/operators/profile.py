"""Statistical profile of a dimension (shape, describe, null counts, histograms,
correlations, cohort comparison, leaderboards, table summaries).

Every statistic is a distributed aggregate: multi-column statistics are computed on a
long (column, value) projection made map-side, so one ``groupBy`` serves all columns;
exact quantiles come from the value histogram of :mod:`logonlens.functions.scoring`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logonlens.functions.metrics import n_unique
from logonlens.functions.scoring import exact_quantiles, join_groups, value_ranks

# The metric columns the exploratory profile studies.
PROFILE_COLUMNS = (
    "total_logins",
    "active_days",
    "avg_daily_authentications",
    "max_daily_authentications",
    "unique_computers",
    "redteam_events",
)
DESCRIBE_QUANTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75}
HISTOGRAM_BINS = 50
STAT_DIGITS = 6


def round_to(x: Column, digits: int = STAT_DIGITS) -> Column:
    """Fixed-digit rounding, ties to even on the scaled value (same rule as round2)."""
    scale = float(10 ** digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def _long(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols
    ])
    return df.select(*group_cols, F.inline(pairs))


def numeric_columns(df: DataFrame) -> list[str]:
    numeric = {"bigint", "int", "smallint", "tinyint", "double", "float"}
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in numeric]


def boolean_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "boolean"]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]


def shape(df: DataFrame) -> DataFrame:
    """STA1: (rows, columns) of a frame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("bigint"))


def null_counts(df: DataFrame) -> DataFrame:
    """STA3: one row, one NULL count per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def _describe_text(df: DataFrame, cols: Sequence[str], g: Sequence[str]) -> DataFrame:
    """Rows of :func:`describe` for text columns: counts, and the first and last in byte order."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in cols])
    return df.select(*g, F.inline(pairs)).groupBy(*g, F.col("metric").alias("column")).agg(
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("null_count"),
        F.min("value").alias("min_text"), F.max("value").alias("max_text"))


def describe(df: DataFrame, cols: Sequence[str] | None = None,
             group_cols: Sequence[str] = (), approximate: bool = False,
             accuracy: int = 10000) -> DataFrame:
    """STA2 / STA6: count, null_count, mean, std (sample), min, p25/p50/p75, max per
    column (and per group). Mean and std are rounded to 6 decimals.

    All columns by default but those of the groups. Booleans have a mean (the share of true), min
    and max as 0 and 1; text has its first and last value as ``min_text`` and ``max_text``; what a
    type does not have is NULL. Columns of other types are left out.

    Quantiles are exact nearest-rank values from the value histogram; ``approximate``
    switches to one ``percentile_approx`` pass (bounded sketch memory, relative rank
    error 1/``accuracy``) for log-sized inputs.
    """
    g = list(group_cols)
    wanted = list(cols) if cols is not None else [c for c in df.columns if c not in g]
    numeric, boolean, text = ([c for c in wanted if c in of(df)] for of in (numeric_columns, boolean_columns, text_columns))
    parts = []
    if numeric or boolean:
        as_numbers = df.withColumns({c: F.col(c).cast("int") for c in boolean})
        is_number = F.col("metric").isin(numeric) if numeric else F.lit(False)
        names = list(DESCRIBE_QUANTILES)
        moments = _long(as_numbers, [*numeric, *boolean], g).groupBy(*g, "metric").agg(
            F.count("value").alias("count"),
            F.count_if(F.col("value").isNull()).alias("null_count"),
            round_to(F.avg("value")).alias("mean"),
            round_to(F.stddev_samp("value")).alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            *([F.percentile_approx("value", list(DESCRIBE_QUANTILES.values()), accuracy).alias("q")] if approximate else []),
        ).withColumn("std", F.when(is_number, F.col("std")))
        if approximate:
            moments = moments.withColumns({n: F.when(is_number, F.col("q")[i]) for i, n in enumerate(names)})
        elif numeric:
            quants = exact_quantiles(value_ranks(df, numeric, g), DESCRIBE_QUANTILES, g)
            moments = join_groups(moments, quants, [*g, "metric"], "left")
        else:
            moments = moments.withColumns({n: F.lit(None).cast("double") for n in names})
        parts.append(moments.withColumnRenamed("metric", "column"))
    if text:
        parts.append(_describe_text(df, text, g))
    if not parts:
        raise ValueError("no column to describe")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    out = out.withColumns({c: F.lit(None).cast(kind) for c, kind in (
        *[(c, "double") for c in ("mean", "std", "min", *DESCRIBE_QUANTILES, "max")], ("min_text", "string"), ("max_text", "string"))
        if c not in out.columns})
    return out.select(*g, "column", "count", "null_count", "mean", "std", "min", "p25", "p50", "p75", "max", "min_text", "max_text")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """STA4: equal-width histogram per column with NumPy's bin rule.

    Edges are ``lo + i * (hi - lo) / bins`` with the last edge exactly ``hi``; a value goes
    to bin i when edge[i] <= x < edge[i+1], the last bin is closed, and a constant column
    is widened to [v - 0.5, v + 0.5]. NULLs are skipped. All ``bins`` bins are returned.
    """
    long = _long(df, cols).where(F.col("value").isNotNull())
    stats = long.groupBy("metric").agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    same = F.col("vmin") == F.col("vmax")
    stats = stats.select(
        "metric",
        F.when(same, F.col("vmin") - 0.5).otherwise(F.col("vmin")).alias("lo"),
        F.when(same, F.col("vmax") + 0.5).otherwise(F.col("vmax")).alias("hi"),
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        return F.when(i >= bins, F.col("hi")).otherwise(i * step + F.col("lo"))

    guess = F.least(
        F.greatest(F.floor((F.col("value") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))),
                   F.lit(0)),
        F.lit(bins - 1),
    ).cast("int")
    binned = long.join(stats, "metric").withColumn("g", guess).withColumn(
        "bin",
        F.when(F.col("value") < edge(F.col("g")), F.col("g") - 1)
        .when((F.col("value") >= edge(F.col("g") + 1)) & (F.col("g") != bins - 1), F.col("g") + 1)
        .otherwise(F.col("g")),
    )
    counts = binned.groupBy("metric", "bin").agg(F.count(F.lit(1)).alias("count"))
    frame = stats.select("metric", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (
        frame.join(counts, ["metric", "bin"], "left")
        .select(
            F.col("metric").alias("column"), "bin",
            edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
    )


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """STA5: Pearson correlation matrix in long form (col_a, col_b, corr), 6 decimals."""
    cols = list(cols)
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(round_to(F.corr(F.col(a).cast("double"), F.col(b).cast("double"))).alias(f"{a}|{b}"))
    wide = df.agg(*aggs)
    pairs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            val = F.col(f"`{a}|{b}`")
            pairs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), val.alias("corr")))
            if a != b:
                pairs.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), val.alias("corr")))
    return wide.select(F.inline(F.array(*pairs)))


def top_by(df: DataFrame, metric: str, k: int = 20, tiebreak: str = "user") -> DataFrame:
    """TOP3: the k rows with the largest ``metric`` (NULLs first, ``tiebreak`` ascending)."""
    return df.orderBy(F.desc_nulls_first(metric), F.asc(tiebreak)).limit(k)


def table_summary(df: DataFrame, cols: Sequence[str], table_name: str,
                  approximate: bool = False) -> DataFrame:
    """STA7: row count and distinct count per column, long form. ``approximate`` swaps
    the exact count for ``approx_count_distinct`` (for log-sized inputs)."""
    def distinct(c: str) -> Column:
        return F.approx_count_distinct(c) if approximate else n_unique(c)

    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[distinct(c).alias(f"d_{c}") for c in cols])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"d_{c}").cast("bigint").alias("distinct_values"))
        for c in cols
    ])
    return wide.select(F.lit(table_name).alias("table_name"), "rows", F.inline(pairs)).select(
        "table_name", "column_name", "rows", "distinct_values")
