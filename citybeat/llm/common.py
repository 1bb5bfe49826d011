"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citybeat.session import scratch_path

# The white space of the word patterns, `[\x20\x09-\x0D]`.
ASCII_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns c0, c1, ... and these by the old names: names of its own then clash with none,
    and a name may hold a dot.  ``toDF(*df.columns)`` gives the old names back."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: rows and generated ids stay fixed when executors are
    lost, and later stages do not repeat the work above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    # The shuffle files of finished plans go once the driver (Python's proxies, then the JVM) collects its garbage.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(df.schema).parquet(path)
    table._shared_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that no later step reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._shared_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def map_rows(
    df: DataFrame,
    columns: list[str],
    process: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` over column lists.

    ``process`` gets an iterator of {column: list} batches of one partition
    and yields {output column: list} batches.  Batches are cut to about
    ``BATCH_BYTES`` of text so that a worker's memory does not follow the
    Arrow batch size.
    """
    return _mapped(df, columns, process, schema, lambda column: column.to_pylist())


def map_arrays(
    df: DataFrame,
    columns: list[str],
    process: Callable[[Iterator[dict[str, pa.Array]]], Iterator[dict[str, list]]],
    schema: str,
) -> DataFrame:
    """``map_rows`` over Arrow columns instead of lists."""
    return _mapped(df, columns, process, schema, lambda column: column)


def _mapped(df: DataFrame, columns: list[str], process: Callable, schema: str, converted: Callable) -> DataFrame:
    picked = df.select(*[F.col(c).alias(c) for c in columns])
    out_schema = _arrow_schema(schema, df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[dict]:
            for batch in batches:
                step = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.nbytes)))
                for lo in range(0, batch.num_rows, step):
                    part = batch.slice(lo, step)
                    yield {c: converted(part.column(i)) for i, c in enumerate(columns)}

        for out in process(parts()):
            yield pa.RecordBatch.from_arrays(
                [_array(out[f.name], f.type) for f in out_schema], schema=out_schema
            )

    return picked.mapInArrow(run, schema)


#: Bytes of Arrow input handed to one step of a Python task.
BATCH_BYTES = 2 << 20


def list_column(rows: list, kind: pa.DataType) -> pa.Array:
    """Numpy arrays as one Arrow list column, without a Python object per value."""
    sizes = [len(r) for r in rows]
    offsets = pa.array([0, *accumulate(sizes)], pa.int32())
    values = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(offsets, pa.array(values.astype(kind.to_pandas_dtype(), copy=False), kind))


def _array(values, kind: pa.DataType) -> pa.Array:
    if not isinstance(values, pa.Array):
        return pa.array(values, type=kind)
    return values if values.type == kind else values.cast(kind)


def _arrow_schema(ddl: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def code_points(text: F.Column) -> F.Column:
    """Number of code points of a string column, 0 for null."""
    return F.coalesce(F.length(text), F.lit(0)).cast("long")
