"""The training-corpus pipeline over ``documents``: quality rules, SimHash near-dedup,
suffix-array dedup, mixing to target weights, byte-level BPE.

Every stage works on all rows the one before it kept, and its decisions take effect: rejected
documents and all but one of each near-duplicate group go, repeated passages are cut out of the
texts, rows come in mixed order, and the last stage gives their token ids and their ``position``
in that order. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logonlens.llm import byte_bpe, mixing, quality, simhash, suffix_dedup
from logonlens.llm.common import cut, release, scratch
from logonlens.llm.queries import MULTI_RANKS

SHINGLE_WORDS, MAX_BITS, REPEAT_BYTES = 3, 2, 100
# Workers outlive their stage: what the encoder keeps in them stands beside the next stages' needs.
MEMO_PIECES, MEMO_STATES, MEMO_PAIRS = 80_000, 8_000, 200_000
FILES_TOGETHER = 4096        # files whose rows are summed up in one window


def keyed(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns, so that no name can clash with the stages' own) and
    ``key``, which tells every row of the written table from all others: file and place."""
    key = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    row = F.struct(*docs.columns).alias("row")
    try:
        return docs.select(row, key.alias("key"))
    except AnalysisException:               # not read from files
        return cut(docs, "keyed").select(row, key.alias("key"))


def rows_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` (:func:`keyed`) whose key is in ``keys.key``."""
    on = (F.col("key.file") == F.col("k.file")) & (F.col("key.at") == F.col("k.at"))
    return docs.join(keys.select(F.col("key").alias("k")), on, "left_semi").select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    all_rows = keyed(docs)
    judged = quality.quality(all_rows.select("row.doc_id", "row.text", "row.lang", "key"), keep=("key",))
    return rows_of(all_rows, judged.where("kept").select("row.key"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of smallest doc_id (rows without an id
    after all others), of several such rows the one whose text has the smallest hash."""
    all_rows = keyed(docs)
    texts = all_rows.select("row.doc_id", "row.text", F.struct(F.xxhash64("row.text").alias("hash"), "key").alias("own"))
    groups = simhash.near_duplicates(texts, SHINGLE_WORDS, MAX_BITS, keep=("own",))
    first = groups.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")).alias("m"))
    return rows_of(all_rows, first.select(F.col("m.own.key").alias("key")))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand earlier in the corpus; ``n_chars`` follows. Bytes
    of a character that was cut into are left out."""
    kept = suffix_dedup.remove_repeats(docs, REPEAT_BYTES, as_text=True).where("n_removed > 0").select(
        F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"),
        F.col("kept").cast("string").alias("own_text")).dropDuplicates(["own_id", "own_hash"])
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    joined = rows.join(kept, F.col("row.doc_id").cast("long").eqNullSafe(F.col("own_id"))
                       & (F.col("hash") == F.col("own_hash")), "left")
    n_chars = F.coalesce(F.length("own_text").cast(docs.schema["n_chars"].dataType), F.col("row.n_chars"))
    return joined.select(F.col("row").withField("text", F.coalesce("own_text", "row.text"))
                         .withField("n_chars", n_chars).alias("row")).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that mixes the sources to their target weights: that of the
    part numbers of the files it is written to, and of the rows in each. The order is found
    from ids, sources and hashes; the texts follow it."""
    all_rows = keyed(docs)
    placed = mixing.mix(all_rows.select("row.source", "row.doc_id", "row.text", "key"), spread_cols=("text",), keep=("key",))
    placed = placed.select("position", F.col("row.key").alias("k"))
    on = (F.col("key.file") == F.col("k.file")) & (F.col("key.at") == F.col("k.at"))
    # every row has its place; files may be far smaller than their texts, which a left join never broadcasts
    return all_rows.join(placed, on, "left").select("row", "position") \
        .repartitionByRange("position").sortWithinPartitions("position").select("row.*")


def written_order(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``, read from files) and ``position`` (from 0), its place in
    written order. A read is no such order: it takes large files first, and splits and packs them."""
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.struct(part.alias("part"), F.col("_metadata.file_name").alias("name"))
                       .alias("file"), F.col("_metadata.row_index").alias("at"))
    # a row per file, summed up within FILES_TOGETHER of them and then over those
    sizes = rows.groupBy(F.col("file").alias("f")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("many", F.floor(F.col("f.part") / FILES_TOGETHER))
    within = Window.partitionBy("many").orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(F.lit(1)).orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    many = sizes.groupBy(F.col("many").alias("m")).agg(F.sum("n").alias("n")) \
        .select("m", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    starts = sizes.withColumn("own", F.coalesce(F.sum("n").over(within), F.lit(0))) \
        .join(many, F.col("many").eqNullSafe(F.col("m"))).select("f", (F.col("first") + F.col("own")).alias("start"))
    # every file has its start; the texts are not to be broadcast (see mix_sources)
    return rows.join(starts, F.col("file.name") == F.col("f.name"), "left").select("row", (F.col("start") + F.col("at")).alias("position"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of ids and of the decoded text; ``position``
    is the document's place in the mixed order, which is also that of the rows."""
    ordered = written_order(docs).select("row.doc_id", "row.text", "position") \
        .repartitionByRange("position").sortWithinPartitions("position")
    coded = byte_bpe.round_trip(ordered, MULTI_RANKS, public_tokenizers.PATTERN, keep=("position",),
                                max_memo=MEMO_PIECES, max_states=MEMO_STATES, max_pairs=MEMO_PAIRS)
    return coded.select("position", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing", mix_sources),
    ("byte-level bpe", encode_texts),
]

#: SQL cannot express the fingerprints, the passages or the encoding; see tests/llm/.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result is written; what its stage wrote on the way, and
    the result that the stage read, are dropped then."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        with scratch() as on_the_way:
            out = stage(spark, docs, sf_dir)
        with scratch() as result:
            docs = cut(out, "stage")
        release(spark, on_the_way + read)
        read = result
    return STAGES[-1][1](spark, docs, sf_dir)
