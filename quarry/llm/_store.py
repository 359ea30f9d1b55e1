"""Intermediate tables and files in the shared folder of the session."""

from __future__ import annotations

import gc
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quarry.config import scratch_dir


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again: cuts the lineage, so that a lost
    executor costs a read and not the steps before."""
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of queries that are over: it does so when the driver has collected their plans."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop(spark: SparkSession, tables: list[DataFrame]) -> None:
    """Delete tables of :func:`written` that nothing reads any more, and the shuffle files of queries that are over."""
    for folder in {os.path.dirname(f) for t in tables for f in t.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    free_shuffles(spark)


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark ignores the case of names)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, as a URI."""
    path = scratch_dir(spark, name)
    return path if "://" in path else path if path.startswith("file:") else "file://" + os.path.abspath(path)


def filesystem(uri: str):
    """pyarrow file system and path of a URI (local or remote)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def put(uri: str, data: bytes) -> None:
    """Write a whole file; a second writer of the same name leaves the same bytes."""
    system, path = filesystem(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{os.getpid()}.tmp"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, path)


def get(uri: str) -> bytes:
    system, path = filesystem(uri)
    with system.open_input_stream(path) as f:
        return f.read()


def opened(uri: str):
    """A file of the shared folder, to be read in parts."""
    system, path = filesystem(uri)
    return system.open_input_file(path)


def batches(rows, schema: pa.Schema, most: int = 4096):
    """Record batches of tuples."""
    some = []
    for r in rows:
        some.append(r)
        if len(some) == most:
            yield _batch(some, schema)
            some = []
    if some:
        yield _batch(some, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
