"""SimHash near-duplicates by multi-index hashing.

**Fingerprints.** Words are the runs of other bytes than space and \\x09-\\x0D, A-Z
lower-cased; shingles are ``shingle_words`` consecutive words joined by a space, repeats
included (fewer words: the whole sequence; none: fingerprint zero). Each shingle has its
64-bit XXH64 (seed 42); a bit of the fingerprint is 1 if it is set in over half of them.

**Links.** Equal fingerprints are folded to one row first, so copies cost nothing. The 64
bits are cut into ``segments``; two fingerprints within ``max_bits`` differ in some segment
by at most ``max_bits // segments`` bits (the segments after the first
``max_bits % segments + 1`` by one bit less). So each fingerprint looks up, in each segment's
table, every value of the small Hamming ball around its own, and complete distances of what
is found there are verified.

A table bucket of over ``bucket_rows`` fingerprints is not listed, since that would compare
all its pairs: for a look-up that meets one, the remaining differing bits are enumerated as
well, and the complete fingerprints so made are joined by equality. Both ways are exact, and
either gives at most a fixed number of rows for each fingerprint.

**Components.** Alternating large-star and small-star steps over the links, written to the
shared checkpoint folder at each step.

Nulls: a NULL text has no words, hence fingerprint zero. A NULL doc_id gives a row like any
other but never names a component. Repeated rows each give a row. An empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logonlens.llm.byte_bpe import slices
from logonlens.llm.common import cut, document_rows

BITS = 64
SEED = 42
SEGMENTS = 2
BUCKET_ROWS = 64
CHUNK = 1 << 16              # shingles whose bits are summed at once


def fingerprint(text: bytes, shingle_words: int) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=">u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, shingle_words: int, id_col: str = "doc_id", text_col: str = "text",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) for every row of ``df``, and its columns ``keep``."""
    def work(batches):
        for part in slices(batches):
            fps = np.array([fingerprint(t, shingle_words) for t in part.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64)), *part.columns[2:]],
                                             ["doc_id", "fp", *keep])

    docs = document_rows(df, id_col, text_col, keep)
    kept = "".join(f", `{name}` {kind}" for name, kind in docs.dtypes[2:])
    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(work, "doc_id long, fp long" + kept)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def flips(low: int, width: int, most: int, least: int = 0) -> list[int]:
    """All masks of ``least`` to ``most`` bits within ``width`` bits from bit ``low``."""
    return [signed(sum(1 << (low + b) for b in bits))
            for n in range(least, most + 1) for bits in combinations(range(width), n)]


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def segments_of(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """Lowest bit, width and ball radius of every segment that has to be looked up."""
    edges = [round(k * BITS / segments) for k in range(segments + 1)]
    radius = [max_bits // segments - (k > max_bits % segments) for k in range(segments)]
    return [(edges[k], edges[k + 1] - edges[k], radius[k]) for k in range(segments) if radius[k] >= 0]


def links(reps: DataFrame, max_bits: int, segments: int = SEGMENTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``a, b`` (a < b): enough pairs within ``max_bits`` of the distinct fingerprints in
    ``reps.fp`` to hold every such pair."""
    looked = segments_of(max_bits, segments)
    mask = {k: signed(((1 << width) - 1) << low) for k, (low, width, _) in enumerate(looked)}
    seg = F.create_map(*[x for k, m in mask.items() for x in (F.lit(k), F.lit(m).cast("long"))])
    index = reps.select("fp", F.explode(F.array(*[F.lit(k) for k in mask])).alias("seg")) \
        .select("seg", F.col("fp").bitwiseAND(seg[F.col("seg")]).alias("key"), "fp")
    sizes = index.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"))
    balls = [F.array(*[F.struct(F.lit(k).alias("seg"), F.lit(m).cast("long").alias("flip"))
                       for m in flips(low, width, radius)]) for k, (low, width, radius) in enumerate(looked)]
    probes = reps.select("fp", F.explode(F.concat(*balls)).alias("p")).select(
        "fp", "p.seg", "p.flip", F.col("fp").bitwiseXOR(F.col("p.flip")).bitwiseAND(seg[F.col("p.seg")]).alias("key"))
    # Spark sizes a table after an explode as if it had no more rows, and would send it to the driver: both joins are by
    # shuffle. A look-up of its own value meets at least the fingerprint itself.
    hits = cut(probes.hint("merge").join(sizes, ["seg", "key"]).where((F.col("flip") != 0) | (F.col("n") > 1)), "simhash-hits")

    small = hits.where(F.col("n") <= bucket_rows).drop("n") \
        .join(index.withColumnRenamed("fp", "other").hint("merge"), ["seg", "key"]) \
        .select(F.col("fp").alias("x"), F.col("other").alias("y")) \
        .where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))).between(1, max_bits))

    rest = []
    for k, (low, width, radius) in enumerate(looked):
        outside = [b for b in range(BITS) if not low <= b < low + width]
        for used in range(radius + 1):
            others = [signed(sum(1 << b for b in bits))
                      for n in range(max_bits - used + 1) for bits in combinations(outside, n)]
            rest.append(hits.where((F.col("n") > bucket_rows) & (F.col("seg") == k)
                                   & (F.bit_count("flip") == used))
                        .select(F.col("fp").alias("x"),
                                F.explode(F.transform(_longs(others), lambda m: F.col("fp").bitwiseXOR(F.col("flip"))
                                                      .bitwiseXOR(m))).alias("y")))
    large = reduce(DataFrame.unionAll, rest).where(F.col("x") != F.col("y")) \
        .join(reps.select(F.col("fp").alias("y")), "y", "left_semi").select("x", "y")
    return small.unionAll(large).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node of ``edges(a, b)``."""
    edges = cut(edges.select(F.col("a").cast("long"), F.col("b").cast("long")), "components")
    while True:
        # large star: every node's larger neighbours move to its smallest neighbour
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # (each has its row in least: of a left join only that side, of known size, can be broadcast)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a", "left") \
            .select(F.col("m").alias("a"), "b").distinct()
        # small star: every node and its smaller neighbours move to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(least, "b")
        small = joined.select(F.col("m").alias("a"), F.col("a").alias("b")) \
            .unionAll(joined.select(F.col("m").alias("a"), "b")).where(F.col("a") != F.col("b")).distinct()
        after = cut(small, "components")
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            return after.select(F.col("b").alias("node"), F.col("a").alias("component")) \
                .unionAll(after.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
        edges = after


def near_duplicates(df: DataFrame, shingle_words: int, max_bits: int, id_col: str = "doc_id",
                    text_col: str = "text", segments: int = SEGMENTS, bucket_rows: int = BUCKET_ROWS,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits), ``component_id`` (the smallest doc_id reachable
    over links of at most ``max_bits`` differing bits) for every row of ``df``; with ``keep``
    also ``component`` (a fingerprint that names the group even where it has no id) and those
    columns of ``df``."""
    docs = cut(fingerprints(df, shingle_words, id_col, text_col, keep), "simhash-fp")
    reps = docs.groupBy("fp").agg(F.min("doc_id").alias("first"))
    reached = components(links(reps.select("fp"), max_bits, segments, bucket_rows))
    named = reps.join(reached, F.col("fp") == F.col("node"), "left") \
        .select("fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_fp = named.select("fp", "component").join(smallest, "component").select("fp", "component_id", "component")
    # files may be far smaller than their rows: docs are not to be broadcast
    return docs.hint("merge").join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *(["component", *keep] if keep else []))
