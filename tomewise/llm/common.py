"""What the operators of this subpackage share: tables, appended columns, bounded samples, broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from tomewise.plans.storage import BROADCAST_BYTES, scratch_dir, store

__all__ = ["append_columns", "held_out", "map_rows", "most_frequent", "sample_by_hash", "scratch_dir", "small", "store", "table"]

# Bytes that a broadcast row of a few numbers takes in a hash table.
ROW_BYTES = 64
BATCH_ROWS = 1000

# Rows of one Arrow batch that are worked on together, so that what a task holds besides the batch is small.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % modulus == remainder


def sample_by_hash(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``rows`` rows (fewer if there are fewer) in the order of a hash of ``key``: the same in every run.

    A large table is first cut to about one and a half times as many rows by another part of the hash, so that what
    is sorted, and what tasks send to the driver, does not grow with the table.
    """
    total = df.count()
    order = F.xxhash64(F.col(key))
    if total > 2 * rows:
        df = df.filter(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1_000_000)) < 1.5e6 * rows / total)
    return df.orderBy(order, F.col(key)).limit(rows)


def most_frequent(counts: DataFrame, rows: int) -> DataFrame:
    """Of a table with counts ``n``, the rows with the largest: at most ``rows``, and like counts together.

    A histogram of the counts, by sixteenths of powers of two, says from which count on the rows are few enough.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    counts = store(counts.withColumn("step", step), "counts")
    sizes = {r["step"]: r["rows"] for r in counts.groupBy("step").agg(F.count("*").alias("rows")).collect()}
    total, least = 0, max(sizes, default=0) + 1
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > rows:
            break
        least = at
    return counts.filter(F.col("step") >= least).drop("step")


def small(df: DataFrame) -> DataFrame:
    """A stored table of a few numbers: marked for broadcast if its measured size allows, else as it is."""
    return F.broadcast(df) if df.count() * ROW_BYTES <= BROADCAST_BYTES else df


def _bound_batches(spark: SparkSession) -> None:
    """Texts can be long: let Arrow batches have at most 1000 rows, unless the session has a lower bound."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def append_columns(
    df: DataFrame, inputs: list[str], fields: list[StructField], start: Callable[[], Callable]
) -> DataFrame:
    """``df`` with ``fields`` computed from ``inputs``; columns of the same names are replaced.

    ``start`` runs once per task and returns a function of lists (one per input column, with None for null)
    that returns lists (one per field). Batches are worked on in slices, and each row stays in its task.
    """
    new = [f.name for f in fields]
    old = [c for c in df.columns if c not in new]
    read = [*old, *(c for c in inputs if c not in old)]
    schema = StructType([*(df.schema[c] for c in old), *fields])
    types = [to_arrow_schema(StructType([f])).field(0).type for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                got = work(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in inputs))
                arrays = [part.column(part.schema.get_field_index(c)) for c in old]
                arrays += [pa.array(values, kind) for values, kind in zip(got, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*old, *new])

    _bound_batches(df.sparkSession)
    return df.select(*(F.col(f"`{c}`") for c in read)).mapInArrow(run, schema)


def map_rows(
    df: DataFrame, inputs: list[str], schema: StructType, start: Callable[[], Callable]
) -> DataFrame:
    """Rows of ``schema`` made from ``inputs``, any number for each row.

    ``start`` runs once per task and returns a function of lists (one per input column) that returns lists
    (one per output column).
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                got = work(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in inputs))
                arrays = [pa.array(values, kind.type) for values, kind in zip(got, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    _bound_batches(df.sparkSession)
    return df.select(*(F.col(f"`{c}`") for c in inputs)).mapInArrow(run, schema)
