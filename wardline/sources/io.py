"""Sources and sinks (warehouse tables, parquet, CSV).

Reads are lazy and columnar: projections and filters applied later reach
the parquet scan (``PushedFilters`` / ``ReadSchema``).  Writes go to
tables or directories, never through the driver.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.session import checkpoint_dir


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn floating NaN into NULL so that aggregates skip it as pandas does."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            cols.append(F.when(F.isnan(c), F.lit(None)).otherwise(c).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load(spark: SparkSession, directory: str, name: str, *, nan_as_null: bool = False) -> DataFrame:
    """Scan table ``name`` stored as ``<directory>/<name>.parquet`` (or a directory of parts)."""
    path = os.path.join(directory, f"{name}.parquet")
    if not os.path.exists(path) and os.path.exists(os.path.join(directory, name)):
        path = os.path.join(directory, name)
    df = spark.read.parquet(path)
    return nan_to_null(df) if nan_as_null else df


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan (``SELECT * FROM name``)."""
    return spark.table(name)


def save(df: DataFrame, target: str, *, mode: str = "overwrite", fmt: str = "parquet",
         partition_by: list[str] | None = None, bucket_by: tuple[int, list[str]] | None = None,
         path: str | None = None, as_table: bool | None = None) -> None:
    """Create-or-replace a table (catalog name) or a directory (path) from a query.

    ``bucket_by`` (number, columns) stores a table in hash buckets sorted by these columns: joins and
    aggregates on them read it without a shuffle of their own.  ``path`` keeps a table's files there
    instead of in the warehouse folder.
    """
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
        as_table = True
    if path is not None:
        writer, as_table = writer.option("path", path), True
    if as_table is None:
        as_table = "/" not in target and "://" not in target
    if as_table:
        writer.saveAsTable(target)
    else:
        writer.save(target)


def save_with_schema(df: DataFrame, target: str, schema: T.StructType, **kw) -> None:
    """Drop-and-replace with an explicit schema: project to its columns and cast.

    Columns of ``df`` not in ``schema`` are dropped; names are matched
    case-insensitively (``SUBJECT_ID`` vs ``subject_id``).
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        c = F.col(src) if src is not None else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    save(df.select(*cols), target, **kw)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (``spark.checkpoint.dir``), or in the warehouse
    folder where none is configured."""
    base = checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def save_bucketed(df: DataFrame, name: str, cols: list[str], buckets: int, **kw) -> DataFrame:
    """Store an event log as a table in ``buckets`` hash buckets of ``cols`` and read it back.

    Rows are dealt by the same hash first, so that every bucket is one file and the
    write is the only shuffle that the log ever needs for these keys.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    save(df.repartition(buckets, *cols), table, bucket_by=(buckets, cols), path=scratch_path(spark, name), **kw)
    return spark.table(table)


def save_checked(df: DataFrame, target: str, schema: T.StructType, expected: Column | int, **kw) -> int:
    """``save_with_schema`` that counts rows while it writes, and raises unless they are as many as expected.

    ``expected`` is a number, or an aggregate over the same rows.  The counts come from the write itself
    (``Observation``): no second pass, no count job.  Returns the number of rows.
    """
    seen = Observation()
    expected = F.lit(expected) if isinstance(expected, int) else expected
    df = df.observe(seen, F.count(F.lit(1)).alias("n"), expected.cast("long").alias("expected"))
    save_with_schema(df, target, schema, **kw)
    n, wanted = seen.get["n"], seen.get["expected"]
    if n != (wanted or 0):
        raise ValueError(f"{target} has {n} rows, expected {wanted}")
    return n


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row; pass a schema in production (inference scans the data twice)."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return nan_to_null(reader.csv(path))


def save_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """CSV with a header row, written by the executors (one file per partition)."""
    df.write.mode(mode).option("header", "true").csv(path)
