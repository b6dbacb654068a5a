"""Small helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logonlens.session import scratch_path

_PAIR_OF_SPACES = re.compile(r"\s\s")
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def document_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Only the id (long) and the text, and the columns ``keep``; a NULL text becomes the empty
    text. Every other column is left behind, so names of the operators' own columns cannot clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *keep)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scratch: ContextVar[list[tuple[str, str | None]] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch() -> Iterator[list[tuple[str, str | None]]]:
    """Lists the folders (and their tables, if any) that operators write inside the block, for
    :func:`release`. Outside of it scratch stays under the checkpoint folder."""
    token = _scratch.set([])
    try:
        yield _scratch.get()
    finally:
        _scratch.reset(token)


def note_scratch(path: str, table_name: str | None = None) -> None:
    if _scratch.get() is not None:
        _scratch.get().append((path, table_name))


def release(spark: SparkSession, written: list[tuple[str, str | None]]) -> None:
    """Drop scratch that nothing will read again."""
    for path, table_name in written:
        if table_name:
            spark.sql(f"DROP TABLE IF EXISTS {table_name}")
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame, name: str, partition_by: list[str] | None = None,
        options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: later stages and
    retries start from the written table. ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, name)
    note_scratch(path)
    writer = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_at_spaces(text: str) -> list[str]:
    """Split at every single space that has a non-space character on both sides. The first
    piece stands as it is, every later piece is understood to start with that space.

    Such a space always starts a new match of the tokenizers' split patterns, so pieces can
    be encoded one by one."""
    if _PAIR_OF_SPACES.search(text) is None and text[:1] != " " and text[-1:] != " ":
        return text.split(" ")
    return _SINGLE_SPACE.split(text)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
