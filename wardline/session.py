"""Session defaults and lineage cutting.

The library never chooses where a cluster keeps its data: a checkpoint
directory configured on the cluster (``spark.checkpoint.dir``) is always
used as is.  A session without one keeps intermediates in Spark's own storage.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "wardline", **conf) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    Explicit ``conf`` wins over the defaults; ``master`` is only set when given
    (a cluster submit supplies its own).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # The time zone must be UTC for NTZ <-> epoch helpers that go through
    # session-zoned timestamps (date_trunc); set it even on a reused session.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint directory, or None where none is configured."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    return None


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Keep a small, reused intermediate: a reliable checkpoint in the shared
    checkpoint dir, or a persisted frame where no such dir is configured.

    Used for small, reused intermediates (anchors, cohorts) so that a lost
    executor does not force recomputation of the whole upstream plan and so
    that later size checks are cheap.
    """
    if checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=eager)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    if eager:
        kept.count()
    return kept


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Put this package on the executors' import path, once per application, for functions that run there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}-core.zip"  # sent by Spark itself
    with zipfile.ZipFile(archive, "w") as out:
        for f in package.rglob("*.py"):
            out.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
