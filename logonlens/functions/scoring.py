"""Global ranks, percentile scores, quantiles, rounding and risk bands.

A whole-frame rank (``Window.orderBy(x)`` with no partition) moves every row to one
task. Instead every rank here is computed from a *value histogram* in two levels of cells:

1. ``hist``: one row per (group, metric, distinct value) with its row count ``c``
   (partial aggregation map-side, then a shuffle of distinct values only).
2. A value's place on a logarithmic scale, ``sign(v) * log2(1 + |v|)``, is cut into coarse cells
   (``buckets`` for each doubling of the value) and each of those into 2 ** 20 fine ones. Cells are
   fixed, monotone functions of the value: no boundaries are sampled, stored or looked up, and a
   retried or repeated stage gives the same ones.
3. Counts are added up by fine and by coarse cell. Running sums over the coarse cells of a metric,
   over the fine cells of a coarse one and over the values of a fine one add up to ``below``.

So every window is bounded whatever the data: some 1,000 coarse cells for each doubling, 2 ** 20
fine cells, and the few distinct numbers that lie within a billionth of each other. Each level
joins the one above by the cell it lies in, never by the metric alone, so no key collects all
values of a metric.

``below`` = number of non-null rows with a strictly smaller value, exact. Cell counts are sums, so a
stored histogram takes a new batch by adding its counts (:class:`StoredRanks`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE_CELLS = 1024         # for each doubling of 1 + |value|
FINE_BITS = 20              # each coarse cell has 2 ** FINE_BITS fine ones
# A value with more than 1 / HOT_SHARE of all rows is scored by a broadcast: at most HOT_SHARE
# values of each metric can have that many, so what is broadcast is bounded.
HOT_SHARE = 2500

# Risk bands (lower bounds, highest first) and the default weights of
# the four percentile scores, in the order they are summed.
RISK_BANDS = (("Critical", 80), ("High", 65), ("Medium", 40))
LOWEST_BAND = "Low"
BAND_ORDER = ("Critical", "High", "Medium", "Low")
RISK_WEIGHTS = (
    ("login_score", 0.20),
    ("computer_score", 0.25),
    ("volume_score", 0.30),
    ("redteam_score", 0.25),
)
RISK_INPUTS = {
    "login_score": "total_logins",
    "computer_score": "unique_computers",
    "volume_score": "max_daily_authentications",
    "redteam_score": "redteam_events",
}


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` where NULL equals NULL (a NULL group is a group); keys come once, from
    the left side."""
    names = {k: f"__right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(names)
    on = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]
    return left.join(renamed, on, how).drop(*names.values())


def fine_cell(value: Column, coarse_cells: int = COARSE_CELLS) -> Column:
    """The fine cell of a value (a bigint that does not fall as values rise; NaN is in the last)."""
    place = F.signum(value) * F.log2(F.lit(1.0) + F.abs(value))
    cell = F.floor(place * F.lit(float(coarse_cells << FINE_BITS)))
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).otherwise(cell).cast("bigint")


def value_histogram(df: DataFrame, columns: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """``group_cols..., metric, value (double), c``: the rows of each distinct value (NULL too)."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ])
    return df.select(*group_cols, F.inline(pairs)).groupBy(*group_cols, "metric", "value").agg(F.count(F.lit(1)).alias("c"))


def merge_histograms(*parts: DataFrame) -> DataFrame:
    """The histogram of all rows of several."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*[c for c in whole.columns if c != "c"]).agg(F.sum("c").alias("c"))


def cell_counts(hist: DataFrame, coarse_cells: int = COARSE_CELLS) -> DataFrame:
    """``group_cols..., metric, coarse, fine, c``: a histogram's counts by cell."""
    g = [c for c in hist.columns if c not in ("value", "c")]
    fine = fine_cell(F.col("value"), coarse_cells)
    return hist.groupBy(*g, F.shiftright(fine, FINE_BITS).alias("coarse"), fine.alias("fine")).agg(F.sum("c").alias("c"))


def ranks_of_histogram(hist: DataFrame, cells: DataFrame | None = None, coarse_cells: int = COARSE_CELLS) -> DataFrame:
    """:func:`value_ranks` from a histogram. ``cells`` are its :func:`cell_counts` (computed if not
    given); ``hist`` may then hold only the values of some fine cells, if all of each."""
    g = [c for c in hist.columns if c not in ("value", "c")]
    cells = cells if cells is not None else cell_counts(hist, coarse_cells)
    known = F.when(F.col("coarse").isNotNull(), F.col("c")).otherwise(F.lit(0))

    def before(column: Column, partition: Sequence[str], order: str) -> Column:
        own = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(own), F.lit(0))

    all_cells = Window.partitionBy(*g)
    coarse = cells.groupBy(*g, "coarse").agg(F.sum("c").alias("c")).select(
        *g, "coarse", before(known, g, "coarse").alias("below_coarse"),
        F.sum("c").over(all_cells).alias("n_all"), F.sum(known).over(all_cells).alias("n_valid"))
    fine = join_groups(cells, coarse, [*g, "coarse"], "inner") \
        .withColumn("below_fine", F.col("below_coarse") + before(F.col("c"), [*g, "coarse"], "fine")) \
        .select(*g, "fine", "below_fine", "n_all", "n_valid")
    values = hist.withColumn("fine", fine_cell(F.col("value"), coarse_cells))
    values = values.withColumn("own", before(F.col("c"), [*g, "fine"], "value"))
    return join_groups(values, fine, [*g, "fine"], "inner").select(
        *g, "value", "c",
        F.when(F.col("value").isNotNull(), F.col("below_fine") + F.col("own")).alias("below"), "n_all", "n_valid")


def value_ranks(df: DataFrame, columns: Sequence[str], group_cols: Sequence[str] = (),
                buckets: int | None = None) -> DataFrame:
    """Exact rank statistics per distinct value of each column (optionally per group).

    Output: ``group_cols..., metric, value (double), c, below, n_all, n_valid``; ``below`` is
    NULL for the NULL value. ``n_all`` counts NULLs, ``n_valid`` does not.

    A NULL group is a group of its own. ``buckets`` is the number of coarse cells for each
    doubling of a value: it changes how work is spread, not the result.
    """
    return ranks_of_histogram(value_histogram(df, columns, group_cols), coarse_cells=buckets or COARSE_CELLS)


class StoredRanks:
    """A population's histogram and cell counts, kept as tables, against which batches are scored.

    Adding a batch adds its counts. Scoring one reads the cells (a row for each distinct value at
    most) and, of the histogram, only the fine cells that the batch's values lie in."""

    def __init__(self, hist: DataFrame, cells: DataFrame):
        self.hist, self.cells = hist, cells

    @staticmethod
    def tables(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """The two tables of a population, to be written."""
        hist = value_histogram(df, columns)
        return hist, cell_counts(hist)

    def merged_tables(self, batch: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """The two tables with the batch added, to be written."""
        hist, cells = self.tables(batch, columns)
        return merge_histograms(self.hist, hist), merge_histograms(self.cells, cells)

    def ranks_with(self, batch: DataFrame, columns: Sequence[str]) -> DataFrame:
        """:func:`value_ranks` of the batch's values among the stored population and the batch."""
        hist, cells = self.tables(batch, columns)
        wanted = cells.select("metric", "fine").distinct()
        own = self.hist.withColumn("fine", fine_cell(F.col("value")))
        renamed = wanted.withColumnsRenamed({"metric": "__metric", "fine": "__fine"})
        touched = own.join(renamed, F.col("metric").eqNullSafe(F.col("__metric")) & F.col("fine").eqNullSafe(F.col("__fine")),
                           "left_semi").drop("fine")
        return ranks_of_histogram(merge_histograms(touched, hist), merge_histograms(self.cells, cells))


def average_rank(below: Column, c: Column) -> Column:
    """WIN1: 1-based rank where ties share the mean of their positions."""
    return below + (c + F.lit(1)) / F.lit(2)


def percentile_score_of(avg_rank: Column, n_all: Column) -> Column:
    """WIN2: (avg_rank - 1) / (n - 1) * 100; NULL when n = 1 (no 0/0)."""
    return (avg_rank - F.lit(1)) / F.nullif(n_all - F.lit(1), F.lit(0)) * F.lit(100)


def scored_inputs(df: DataFrame, inputs: Sequence[str], keys: Sequence[str], ranks: DataFrame) -> DataFrame:
    """``keys..., __metric, __score``: a row for each input of each row of ``df``.

    A value that holds many rows (most users have no red-team event) is scored by a broadcast of
    the few such values, and its rows get a key of their own in the shuffled join of the others,
    which spreads them evenly with or without adaptive planning."""
    scored = ranks.select(
        "metric", "value", percentile_score_of(average_rank(F.col("below"), F.col("c")), F.col("n_all")).alias("score"),
        (F.col("c") * HOT_SHARE > F.col("n_all")).alias("hot")).where("value IS NOT NULL")
    hot = scored.where("hot").select(F.col("metric").alias("__hot_metric"), F.col("value").alias("__hot_value"),
                                     F.col("score").alias("__hot_score"), F.lit(True).alias("__hot"))
    cold = scored.where("NOT hot").select(F.col("metric").alias("__cold_metric"), F.col("value").alias("__cold_value"),
                                          F.col("score").alias("__cold_score"))
    pairs = F.array(*[
        F.struct(F.lit(c).alias("__metric"), F.col(c).cast("double").alias("__value")) for c in inputs
    ])
    # at most HOT_SHARE rows for each metric
    long = df.select(*keys, F.inline(pairs)).join(
        F.broadcast(hot), (F.col("__metric") == F.col("__hot_metric")) & (F.col("__value") == F.col("__hot_value")), "left")
    done = F.col("__hot").isNotNull() | F.col("__value").isNull()
    # no metric has an empty name: such rows meet nothing, and go where their own hash sends them
    long = long.withColumn("__join_metric", F.when(done, F.lit("")).otherwise(F.col("__metric"))) \
        .withColumn("__join_value", F.when(done, F.xxhash64(*keys, "__metric").cast("double")).otherwise(F.col("__value")))
    return long.join(cold, (F.col("__join_metric") == F.col("__cold_metric"))
                     & (F.col("__join_value") == F.col("__cold_value")), "left") \
        .select(*keys, "__metric", F.coalesce("__hot_score", "__cold_score").alias("__score"))


def score_columns(df: DataFrame, scores: Mapping[str, str], key: str | Sequence[str],
                  buckets: int | None = None, ranks: DataFrame | None = None) -> DataFrame:
    """``key`` and one percentile score column per ``{output: input}`` pair, for every row of ``df``.

    Score of a row = percentile of its value among *all* rows of ``df`` (NULLs count in
    n and get a NULL score), or by the given ``ranks``. Range 0-100, ties share their average rank.
    ``key`` must identify a row.

    Only the key and the inputs are unpivoted to (metric, value), joined to the score of the value
    (:func:`scored_inputs`) and pivoted back by key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    inputs = list(dict.fromkeys(scores.values()))
    ranks = ranks if ranks is not None else value_ranks(df, inputs, buckets=buckets)
    return scored_inputs(df, inputs, keys, ranks).groupBy(*keys).agg(*[
        F.max(F.when(F.col("__metric") == src, F.col("__score"))).alias(name) for name, src in scores.items()])


def percentile_scores(df: DataFrame, scores: Mapping[str, str], key: str | Sequence[str],
                      buckets: int | None = None) -> DataFrame:
    """``df`` with the columns of :func:`score_columns`, joined back by key."""
    keys = [key] if isinstance(key, str) else list(key)
    return join_groups(df, score_columns(df, scores, keys, buckets), keys, "left").select(*df.columns, *scores.keys())


def exact_quantiles(ranks: DataFrame, quantiles: Mapping[str, float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Nearest-rank quantiles from :func:`value_ranks`: the value at 0-based sorted index
    ``floor(q * (n - 1) + 0.5)`` of the non-null values. One row per (group, metric)."""
    g = list(group_cols)
    valid = ranks.where(F.col("value").isNotNull())
    picks = []
    for name, q in quantiles.items():
        idx = F.floor(F.lit(q) * (F.col("n_valid") - 1) + F.lit(0.5))
        hit = (F.col("below") <= idx) & (idx < F.col("below") + F.col("c"))
        picks.append(F.max(F.when(hit, F.col("value"))).alias(name))
    return valid.groupBy(*g, "metric").agg(*picks)


def round2(x: Column) -> Column:
    """MTH2 / MTH3: two decimals, ties to even on ``x * 100`` (matches DuckDB's
    ``round_even(x * 100, 0) / 100`` bit for bit)."""
    return F.rint(x * F.lit(100)) / F.lit(100)


def weighted_sum(weights: Sequence[tuple[str, float]]) -> Column:
    """MTH1: left-to-right sum of ``col * weight`` in the given term order."""
    total = None
    for col, w in weights:
        term = F.col(col) * F.lit(float(w))
        total = term if total is None else total + term
    return total


def risk_level(score: str | Column = "risk_score") -> Column:
    """CAS1: Critical >= 80, High >= 65, Medium >= 40, else (NULL included) Low."""
    s = F.col(score) if isinstance(score, str) else score
    expr = None
    for label, lower in RISK_BANDS:
        expr = F.when(s >= lower, F.lit(label)) if expr is None else expr.when(s >= lower, F.lit(label))
    return expr.otherwise(F.lit(LOWEST_BAND))


def band_ordinal(level: str | Column = "risk_level") -> Column:
    """CAS2: strict label -> ordinal; an unknown label fails the query."""
    lv = F.col(level) if isinstance(level, str) else level
    expr = None
    for i, label in enumerate(BAND_ORDER):
        expr = F.when(lv == label, F.lit(i)) if expr is None else expr.when(lv == label, F.lit(i))
    return expr.otherwise(
        F.raise_error(F.concat(F.lit("unknown risk_level: "), F.coalesce(lv, F.lit("NULL"))))
    ).cast("int")
