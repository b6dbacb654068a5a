"""Mixing sources to target weights by Pfair scheduling, in built-in functions only.

The mixed order is a row of slots, each for half a block of one source. With a share ``p`` of
the slots, half-block ``i`` is released at slot ``floor(i / p)`` and due at ``(i + 1/2) / p``,
the middle of its Pfair window. Between two claimants whose shares make one, earliest deadline
first is then plain arithmetic: one has had ``floor(t * p + 1/2)`` of the first ``t`` slots, the
other the rest. More sources are paired in a tree by weight, the two lightest first: each pair
shares out the slots that the pair as a whole gets, and a half-block's slot is found by climbing
from its source to the root. So slots follow from the target weights themselves, at any distance
from the start and for any number of sources, and need no schedule made one slot after the other.

A pair adds at most half a slot to the deviation that it inherits, and hands on its share of it.
In such a tree a pair inside another has at most 2/3 of it, so no source is ever two slots, that
is a whole block, away from its target weight (as long as all sources still have documents).

Inside a source the documents are put in the order of a seeded hash of the id and ``spread_cols``
and numbered by counts per (source, hash bucket) and running sums within a bucket, so a source
or an id that holds most rows is spread over all buckets. Equal rows are counted together.

Every document is placed exactly once. When a source runs out its later slots stay empty,
and the others go on in proportion to their weights.

Nulls: rows with a NULL source form a source of their own; a NULL id sorts first among equal
hashes. Repeated rows each get a place. An empty table gives an empty result. A weight that is
missing or not above zero is an error. The sources (a row each) are folded in one row, so there
should be some ten thousands of them at most.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logonlens.llm.common import cut

BLOCK_ROWS = 16              # dealt in two halves
BUCKETS_PER_PARTITION = 4
SEED = "mix-1"
TEMPERATURE = 0.5            # without given weights: (documents of the source) ** 0.5


def weighted(sizes: DataFrame, weights: Mapping[str, float] | None, temperature: float) -> DataFrame:
    """``source, n, w``: the target weight of every source (not normalized)."""
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        weight = given[F.col("source")].cast("double")
    wrong = F.raise_error(F.concat(F.lit("no target weight above zero for source "), F.coalesce("source", F.lit("NULL"))))
    return sizes.withColumn("w", weight).withColumn(
        "w", F.when((F.col("w") > 0) & (F.col("w") < float("inf")), F.col("w")).otherwise(wrong.cast("double")))


def pair_links(queue: Column) -> Column:
    """The links of the tree over ``queue`` (an array of (w, k), ascending): child, parent, the
    child's share of the pair, and whether it is the first of it. The lightest two are paired,
    again and again; pair ``m`` gets the number after all sources and pairs before it."""
    size = F.size(queue)

    def join(state, m):
        x, y = state["queue"][0], state["queue"][1]
        both, parent = x["w"] + y["w"], size + m - 1
        pair = F.array(F.struct(both.alias("w"), parent.alias("k")))
        return F.struct(
            F.sort_array(F.concat(F.slice(state["queue"], 3, F.greatest(F.size(state["queue"]) - 2, F.lit(0))), pair)).alias("queue"),
            F.concat(state["links"], F.array(*[F.struct(z["k"].alias("child"), parent.alias("parent"), (z["w"] / both).alias("p"),
                                                        F.lit(first).alias("first")) for z, first in ((x, True), (y, False))])).alias("links"))

    none = F.array().cast("array<struct<child:int,parent:int,p:double,first:boolean>>")
    start = F.struct(queue.cast("array<struct<w:double,k:int>>").alias("queue"), none.alias("links"))
    return F.when(size > 1, F.aggregate(F.sequence(F.lit(1), size - 1), start, join)["links"]).otherwise(none)


def paths(links: str, n_sources: Column) -> Column:
    """The way up from every source: an array (one entry per source) of arrays of (p, first)."""
    none = F.array().cast("array<struct<p:double,first:boolean>>")

    def climb(state, x):
        step = F.array(F.struct(x["p"].alias("p"), x["first"].alias("first")))
        return F.transform(state, lambda q, i: F.when(i == x["child"], F.concat(step, F.get(state, x["parent"]))).otherwise(q))

    return F.aggregate(F.reverse(links), F.array_repeat(none, (2 * n_sources - 1).cast("int")), climb)


def slot_of(path: str, i: Column) -> Column:
    """The slot of half-block ``i`` of the source with this path."""
    return F.aggregate(path, i.cast("bigint"), lambda t, e: F.when(e["first"], F.ceil((t + 0.5) / e["p"]) - 1)
                       .otherwise(F.floor((t + 0.5) / e["p"])))


def schedule(sizes: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """``source, n, w, path`` for every row of ``sizes`` (source, n)."""
    one = weighted(sizes, weights, temperature).agg(F.sort_array(F.collect_list(F.struct("w", "source", "n"))).alias("sources"))
    one = one.where(F.size("sources") > 0)
    queue = F.transform("sources", lambda x, k: F.struct(x["w"].alias("w"), k.alias("k")))
    one = one.withColumn("links", pair_links(queue))
    # one row, written between the folds so that each runs once
    one = cut(one, "mixing-tree").withColumn("paths", paths("links", F.size("sources")))
    return cut(one.select(F.posexplode("sources").alias("k", "x"), "paths")
               .select("x.source", "x.n", "x.w", F.get("paths", F.col("k")).alias("path")), "mixing-schedule")


def numbered(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` (source, doc_id, h and more), each with its number ``k`` in its source by h."""
    same = [F.col(c) for c in rows.columns]
    bucket = F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint") * buckets, 32)
    groups = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("c")).withColumn("bucket", bucket)
    sizes = rows.withColumn("bucket", bucket).groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("c"))
    # at most ``buckets`` rows for each source
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                          F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"))
    rest = [c for c in rows.columns if c not in ("source", "h")]
    in_bucket = Window.partitionBy("source", "bucket").orderBy("h", *rest).rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("earlier", F.coalesce(F.sum("c").over(in_bucket), F.lit(0))) \
        .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))) \
        .withColumn("first", F.col("start") + F.col("earlier"))
    # rows that are equal in all follow each other; a long run of them is dealt out in steps
    step = 1 << 16
    runs = placed.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("c") - 1) / step))))
    return runs.withColumn("k", F.explode(F.sequence(
        F.col("first") + F.col("run") * step, F.col("first") + F.least(F.col("c"), (F.col("run") + 1) * step) - 1))) \
        .select(*rows.columns, "k")


def mix(df: DataFrame, source_col: str = "source", id_col: str = "doc_id", spread_cols: tuple[str, ...] = (),
        weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS, temperature: float = TEMPERATURE,
        seed: str = SEED, buckets: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source, block, slot, position`` for every row of ``df``: its block within its
    source, the slot of its half of the block, and its place (from 0) in the mixed order of all
    rows. ``keep`` names further (orderable) columns of ``df`` to hand on as ``row`` (a struct)."""
    if block_rows < 2 or block_rows % 2:
        raise ValueError("block_rows must be even: a block is dealt in two halves")
    half = block_rows // 2
    spark = df.sparkSession
    buckets = buckets or BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = [F.md5(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in spread_cols]
    rows = cut(df.select(
        F.col(source_col).cast("string").alias("source"), F.col(id_col).cast("long").alias("doc_id"),
        F.md5(F.concat_ws("/", F.coalesce(F.col(id_col).cast("string"), F.lit("")), *spread, F.lit(seed))).alias("h"),
        *([F.struct(*keep).alias("row")] if keep else [])), "mixing-rows")
    plan = schedule(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n")), weights, temperature)
    last = plan.agg(F.max(slot_of("path", F.floor((F.col("n") - 1) / half)))).first()[0]
    timed = numbered(rows, buckets).join(plan.select(F.col("source").alias("s"), "path"),
                                         F.col("source").eqNullSafe(F.col("s")))
    timed = cut(timed.withColumn("slot", slot_of("path", F.floor(F.col("k") / half))).drop("path", "s", "h"), "mixing-slots")
    width = (last or 0) // buckets + 1
    stretch = F.floor(F.col("slot") / width)
    # at most ``buckets`` rows in one window
    before = Window.partitionBy(F.lit(1)).orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    starts = timed.groupBy(stretch.alias("of")).agg(F.count(F.lit(1)).alias("c")) \
        .select("of", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("stretch").orderBy("slot", "source", "k")
    return timed.withColumn("stretch", stretch).withColumn("place", F.row_number().over(within)) \
        .join(starts, F.col("stretch") == F.col("of")) \
        .select("doc_id", "source", F.floor(F.col("k") / block_rows).alias("block"), "slot",
                (F.col("start") + F.col("place") - 1).alias("position"), *(["row"] if keep else []))
