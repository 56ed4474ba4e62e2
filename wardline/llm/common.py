"""Shared helpers: row identity, stage tables in the shared folder, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session (tests) without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = configured or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="stage-")
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage,
    so that a lost executor costs no more than its own tasks.  The shuffle files of the
    write go once it has ended, as nothing reads them again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def with_uid(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add ``uid`` (long), unique per row.

    Where the ids are whole numbers, unique and not null, ``uid`` is the id and this costs one
    aggregate over the id column.  Otherwise (repeated or null ids, or ids of another type, which may
    become equal or fail as numbers) the rows are written once with a generated number, so that it
    stays the same on every read.
    """
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return stage_table(docs.withColumn("uid", F.monotonically_increasing_id()), "uid")
    bad = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(id_col).isNull())
    if bad.limit(1).count() == 0:
        return docs.withColumn("uid", F.col(id_col).cast("long"))
    return stage_table(docs.withColumn("uid", F.monotonically_increasing_id()), "uid")


def texts_of(docs: DataFrame, *cols: str, text_col: str = "text") -> DataFrame:
    """The named columns and the text, null as empty; other columns are dropped."""
    return docs.select(*cols, F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], col: str = "text", most_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most_bytes`` of ``col`` each (one long row may
    exceed it), so that the working arrays of a task stay bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(col))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(off, off[start] + most_bytes, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, and the row offsets into them."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    raw = arr.buffers()
    off = np.frombuffer(raw[1], np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def binary_rows(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose row i holds the bytes of values[offsets[i]:offsets[i+1]]."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1,
        [None, pa.py_buffer((offsets * width).astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def list_rows(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def table_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession, rows: int = 1000) -> None:
    """Small Arrow batches (rows hold whole texts, so the default 10,000 may be large), and
    this package on the executors' import path, once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for f in package.rglob("*.py"):
            out.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


_shipped: set[str] = set()
