"""Helpers shared by the operators: staging, row locators, size-checked broadcasts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse.session import fresh_path

#: Rows up to which a narrow table (keys and a few numbers) is broadcast; beyond it
#: the same join is shuffled. 100,000 rows of at most about 200 bytes are 20 MB.
BROADCAST_ROWS = 100_000

#: Rows of an Arrow batch while a stage is written: the buffers of a batch stand in the
#: executor's JVM and in its Python worker at once, beside what the worker makes of them.
ARROW_ROWS = 1000
_ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage and
    fixes the rows for every later reader, also after the loss of an executor."""
    path = fresh_path(spark, name)
    rows = spark.conf.get(_ARROW_ROWS_KEY)
    spark.conf.set(_ARROW_ROWS_KEY, str(ARROW_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_ARROW_ROWS_KEY, rows)
    return spark.read.schema(df.schema).parquet(path)


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, a function for ``mapInArrow``, that hands memory it no longer uses back
    to the system before every further batch and at its end. Python workers serve task after
    task; without this each keeps the largest batch it has ever seen."""

    def lean_run(batches: Batches) -> Batches:
        def fed() -> Batches:
            for batch in batches:
                yield batch
                hand_back()

        try:
            yield from run(fed())
        finally:
            hand_back()

    return lean_run


def hand_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with these columns in place of those of equal names, else at the end, as
    ``DataFrame.withColumns`` makes the schema."""
    names, columns = list(batch.schema.names), list(batch.columns)
    for name, column in new.items():
        at = next((i for i, n in enumerate(names) if n.lower() == name.lower()), len(names))
        names[at : at + 1], columns[at : at + 1] = [name], [column]
    return pa.RecordBatch.from_arrays(columns, names=names)


PLACE = ("_metadata.file_path", "_metadata.row_index")


def stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` if its rows have places (it is read from Parquet), else a staged copy."""
    try:
        df.select(*PLACE)
        return df
    except AnalysisException:
        return staged(spark, df, "rows")


def located(df: DataFrame, *cols: Column) -> DataFrame:
    """``cols`` of a ``stored`` frame with the place of each row: ``loc_file``, ``loc_row``."""
    return df.select(*cols, F.col(PLACE[0]).alias("loc_file"), F.col(PLACE[1]).alias("loc_row"))


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else as it is
    (the join is then a shuffle). ``df`` should be a staged narrow table."""
    return F.broadcast(df) if df.count() <= max_rows else df


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
