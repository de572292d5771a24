"""Reading documents and writing intermediate tables of the corpus operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import configure, is_small, scratch_path, shared_dir

from . import arrays

# Rows that go to Python at a time; the operators then work on a few MB at a time.
ARROW_ROWS = 500
# Whether Spark removes the shuffle files of a query when it ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the library's settings, bound what a Python worker holds at once, and name the shared folder."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    shared_dir(spark)
    return spark


def stored(df: DataFrame, name: str, clean: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and no lost executor repeats it.

    With ``clean`` Spark removes the write's shuffle files as soon as it is done, not when the driver
    happens to collect its garbage, so the next step has their disk.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEAN, "false")
    try:
        if clean:
            spark.conf.set(CLEAN, "true")
        df.write.parquet(path)
    finally:
        if clean:
            spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``gone`` (doc_id); those without an id stay.

    A list that was measured to be small is broadcast, so texts stay where they are.
    """
    gone = stored(gone.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType)).distinct(), "gone")
    gone = F.broadcast(gone) if is_small(gone) else gone
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, d (crc32 of the text), body (the text as compressed UTF-8, to move it with less disk)."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            values = [arrays.utf8(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "d": [zlib.crc32(v) for v in values], "body": [tool.compress(v) for v in values]})

    return docs.mapInPandas(pack, "doc_id long, d long, body binary")


def unpacked(bodies: Iterable[bytes]) -> Iterator[bytes]:
    tool = zstandard.ZstdDecompressor()
    return map(tool.decompress, bodies)
