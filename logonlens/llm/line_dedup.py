"""Line dedup: lines whose key also stands in an earlier document, in built-in functions only.

A line's key is the line without white space at both ends, A-Z lower-cased. A key of at least
``MIN_CHARS`` code points keeps its lines in the document of smallest id that holds it and loses
those in every other one; all other lines stay.

**Method.** Each line with such a key becomes a small row: 128 bits of hash, document, position.
The rows (no text) are written once, range-partitioned by hash and sorted by hash, document and
position, so a task streams over each key's rows with the first occurrence in front. What comes
back per document is a compressed bitmap of the lines to keep: 64 lines a word, and only the words
that lose a line.

**Hot keys.** A bounded sketch of frequent items (at most ``TRACKED`` of them) over the hashes finds
the keys with many rows. Their rows are dealt over salts in the range partitioning, and their first
document comes from an aggregate that folds in the map tasks. The sketch only decides how rows are
spread; whatever it misses is still judged exactly.

Nulls: a NULL text is one empty line; rows with a NULL id count as one document after all others.
Rows of one id count as one document, each with its own lines. Rows equal in id and text each give
a row. Empty lines and short keys always stay. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logonlens.llm.common import cut, document_rows, lower_ascii

WHITE = " \t\n\x0b\f\r"
MIN_CHARS = 10
TRACKED = 16_384             # frequent items that the sketch tracks: the bound of what is broadcast
GROUPS_PER_PARTITION = 4     # a group should have at most this part of a task's even share
LAST_ID = (1 << 63) - 1      # stands for a NULL id


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = document_rows(df, id_col, text_col)
    return docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1, h2, doc, text_hash, at``: every line with a key long enough."""
    lines = F.transform(F.split(lower_ascii(F.col("text")), "\n"),
                        lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(WHITE)).alias("key")))
    long_ones = F.filter(lines, lambda x: F.length(x["key"]) >= min_chars)
    return docs.select("doc", "text_hash", F.inline(long_ones)) \
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), "doc", "text_hash", "at")


def frequent(rows: DataFrame, partitions: int, tracked: int = TRACKED) -> DataFrame:
    """``hot, salts``: hashes (h1) with more rows than a group should have; ``tracked`` at most."""
    items = rows.agg(F.expr(f"approx_top_k(h1, {tracked // 2}, {tracked})").alias("items"), F.count(F.lit(1)).alias("n"))
    share = F.greatest(F.lit(1), F.ceil(F.col("n") / (partitions * GROUPS_PER_PARTITION)))
    return items.select(F.inline("items"), share.alias("share")) \
        .select(F.col("item").alias("hot"), F.ceil(F.col("count") / F.col("share")).alias("salts")).where("salts > 1")


def dropped_lines(rows: DataFrame) -> DataFrame:
    """``doc, text_hash, at`` of the lines that go. ``rows``: a written table of :func:`line_rows`."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = cut(frequent(rows, partitions), "line-hot")
    # bounded broadcasts: hot has at most TRACKED rows, and each of them one first document
    hot_first = rows.join(F.broadcast(hot), F.col("h1") == F.col("hot")) \
        .groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2")).agg(F.min("doc").alias("hot_first"))
    salt = F.coalesce(F.pmod(F.xxhash64("doc", "text_hash", "at"), F.col("salts")), F.lit(0))
    ranged = rows.join(F.broadcast(hot), F.col("h1") == F.col("hot"), "left").select(*rows.columns, salt.alias("salt")) \
        .repartitionByRange("h1", "h2", "salt")
    stream = Window.partitionBy("h1", "h2", "salt").orderBy("doc", "at") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.withColumn("first", F.first("doc").over(stream)) \
        .join(F.broadcast(hot_first), (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")), "left") \
        .where(F.col("doc") != F.coalesce("hot_first", "first")).select("doc", "text_hash", "at")


def keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc, text_hash, keep, n_dropped`` for the texts that lose lines. ``keep`` is a compressed
    bitmap: (word, bits) of every 64 lines of which some go, ascending by word; bit ``i`` of
    ``word`` is set if line ``64 * word + i`` stays. All lines of other words stay."""
    rows = cut(line_rows(_documents(df, id_col, text_col), min_chars), "line-hashes")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    words = dropped_lines(rows).groupBy("doc", "text_hash", F.floor(F.col("at") / 64).cast("int").alias("word")) \
        .agg(F.bit_or(bit).alias("gone"))
    return words.groupBy("doc", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"))


def kept_lines(text: Column, every_word: Column) -> Column:
    """The lines of ``text`` that stay by the words ``every_word`` (those after its last: all)."""
    def stays(_, i):
        word = F.get(every_word, F.floor(i / 64).cast("int"))
        return F.coalesce(F.getbit(word, (i % 64).cast("int")) == 1, F.lit(True))

    return F.filter(F.split(text, "\n"), stays)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` (the text without the lines that go) for every row of ``df``."""
    maps = keep_bitmaps(df, id_col, text_col, min_chars)
    # the words between those in the bitmap, all ones, are put in before the join
    gap = F.transform("keep", lambda x, j: F.concat(
        F.array_repeat(F.lit(-1).cast("long"), (x["word"] - F.coalesce(F.get("keep", j - 1)["word"], F.lit(-1)) - 1).cast("int")),
        F.array(x["bits"])))
    maps = maps.select(F.col("doc").alias("d"), F.col("text_hash").alias("t"), F.flatten(gap).alias("every_word"), "n_dropped")
    docs = _documents(df, id_col, text_col)
    kept = F.when(F.col("n_dropped").isNull(), F.col("text")).otherwise(
        F.array_join(kept_lines(F.col("text"), F.col("every_word")), "\n"))
    return docs.join(maps, (F.col("doc") == F.col("d")) & (F.col("text_hash") == F.col("t")), "left").select(
        "doc_id", (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def digests(df: DataFrame) -> DataFrame:
    return dedup_lines(df).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
