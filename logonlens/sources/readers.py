"""Readers for the raw logs (headerless, usually gzip CSV) and for stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from logonlens.sources.schemas import AUTH, REDTEAM

# The extra spellings pandas' CSV reader turns into missing values
# by default. Spark keeps them as text; ``pandas_nulls=True`` mirrors pandas.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _read_headerless(spark: SparkSession, path: str | list[str], schema, mode: str,
                     pandas_nulls: bool) -> DataFrame:
    df = (
        spark.read.schema(schema)
        .option("header", "false")
        .option("mode", mode)
        .csv(path)
    )
    return _with_pandas_nulls(df, schema) if pandas_nulls else df


def _with_pandas_nulls(df: DataFrame, schema: StructType) -> DataFrame:
    return df.withColumns({
        f.name: F.when(F.col(f.name).isin(*PANDAS_NULL_TOKENS), None).otherwise(F.col(f.name))
        for f in schema.fields if f.dataType.typeName() == "string"
    })


# What an ingest adds to the columns of a log.
ACCEPTED, REJECTED = "accepted", "rejected"
REJECT_COLUMNS = ("bad_line", "reason", "source_file")


def read_checked(spark: SparkSession, path: str | list[str], schema: StructType,
                 pandas_nulls: bool = False) -> DataFrame:
    """SRC1 / SRC2 without stopping at a bad line: the columns of ``schema``, and ``outcome``.

    A line with another number of fields, or with a value that is not of its column's type, is
    ``rejected``: its columns are NULL, and ``bad_line``, ``reason`` (``fields`` or ``value``) and
    ``source_file`` say what it was. All other lines are ``accepted``, and these three are NULL.
    Empty lines are no lines."""
    df = (
        spark.read.schema(StructType([*schema.fields, StructField("bad_line", StringType())]))
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "bad_line")
        # else only the columns that a query needs are parsed, and bad fields elsewhere are missed
        .option("columnPruning", "false")
        .csv(path)
    )
    bad = F.col("bad_line").isNotNull()
    file = F.col("_metadata.file_path")
    df = df.select(
        *[F.when(~bad, F.col(f.name)).alias(f.name) for f in schema.fields], "bad_line",
        F.when(bad & (F.size(F.split("bad_line", ",")) != len(schema.fields)), "fields").when(bad, "value").alias("reason"),
        F.when(bad, file).alias("source_file"),
        F.when(bad, REJECTED).otherwise(ACCEPTED).alias("outcome"))
    return _with_pandas_nulls(df, schema) if pandas_nulls else df


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The accepted rows of a bronze table, written with or without rejects beside them."""
    df = read_table(spark, path)
    if "outcome" not in df.columns:
        return df
    return df.where(F.col("outcome") == ACCEPTED).drop("outcome", *REJECT_COLUMNS)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``bad_line, reason, source_file`` of the rejected lines of a bronze table."""
    return read_table(spark, path).where(F.col("outcome") == REJECTED).select(*REJECT_COLUMNS)


def read_auth_csv(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST",
                  pandas_nulls: bool = False) -> DataFrame:
    """SRC1: the 9-column auth log. ``.gz`` files are one read task each; the
    bronze writer repartitions before writing so later stages are parallel."""
    return _read_headerless(spark, path, AUTH, mode, pandas_nulls)


def read_redteam_csv(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST",
                     pandas_nulls: bool = False) -> DataFrame:
    """SRC2: the 4-column red-team log."""
    return _read_headerless(spark, path, REDTEAM, mode, pandas_nulls)


# gzip text logs expand about tenfold; used to size write parallelism from file sizes.
GZIP_EXPANSION = 10


def input_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Estimated uncompressed bytes under ``path`` from the file system listing only
    (no pass over the data; works for any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in ([path] if isinstance(path, str) else path):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        it = fs.listFiles(hp, True)
        while it.hasNext():
            status = it.next()
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            total += status.getLen() * (GZIP_EXPANSION if name.endswith(".gz") else 1)
    return total


def read_by_day(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A fact in one folder a day, with the columns and types it was built with (a folder's name
    alone gives an int, as the last column)."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC3-SRC5: a parquet file or a directory of parts (implicit UNION ALL)."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)
