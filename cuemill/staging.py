"""Tables written to the folder that all executors share, and read back."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Where it is unset and the master is this
    machine (tests), a temporary folder is made; on a cluster that is an error, since no other machine would see it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="cuemill-")
    return _local[app]


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def new_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark).rstrip('/')}/cuemill-{app}/{name}-{uuid.uuid4().hex}"
    if app not in _made:
        _made[app] = []

        @atexit.register
        def _clean() -> None:
            for p in _made.pop(app, []):
                try:
                    _delete(spark, p)
                except Exception:  # the session may be gone at exit
                    return

    _made[app].append(path)
    return path


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at files that outlive executors. options: the writer's."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def drop_staged(*tables: DataFrame) -> None:
    for df in tables:
        path = getattr(df, "staged_path", None)
        if path:
            _delete(df.sparkSession, path)
