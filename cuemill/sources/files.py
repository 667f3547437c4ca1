"""Text, JSON and listing sources."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import patterns as P
from ..functions import text as X


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """line_idx, value of a small configuration file, in file order (one split, so one task numbers the lines)."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", P.LINE_BREAK)).alias("line_idx", "value"))


def seed_sources(spark: SparkSession, path: str) -> DataFrame:
    """source_idx, domain, url, note. One column is a URL of domain `unknown`, two are domain and URL."""
    rows = _lines(spark, path).withColumn("value", X.strip(F.col("value"))).filter("value <> '' and not startswith(value, '#')")
    p = F.transform(F.split("value", "\t"), X.strip)
    part = lambda i: F.coalesce(F.get(p, i), F.lit(""))
    one = F.size(p) == 1
    order = F.row_number().over(Window.orderBy("line_idx")) - 1
    return rows.select(order.alias("source_idx"), F.when(one, "unknown").otherwise(part(F.lit(0))).alias("domain"), F.when(one, part(F.lit(0))).otherwise(part(F.lit(1))).alias("url"), part(F.lit(2)).alias("note"))


def vocabulary(spark: SparkSession, low: str, high: str) -> DataFrame:
    """word, in_low, in_high from two lists (first TAB column, lower case). An empty list is an error, a missing file an empty list."""

    def words(path: str, flag: str) -> DataFrame:
        try:
            found = spark.read.text(path)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            found = spark.createDataFrame([], "value string")
        found = found.select(F.lower(X.strip(F.get(F.split(X.strip(F.col("value")), "\t"), F.lit(0)))).alias("word")).distinct()
        if found.isEmpty():
            raise ValueError(f"vocabulary is empty: {path}")
        return found.withColumn(flag, F.lit(True))

    return words(low, "in_low").join(words(high, "in_high"), "word", "full").select("word", "in_low", F.coalesce("in_high", F.lit(False)).alias("in_high")).filter("in_low")


def denylist(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(X.strip(F.col("value")).alias("abbr")).filter("abbr <> '' and not startswith(abbr, '#')").distinct()


def records(spark: SparkSession, path: str, schema: str = schemas.ABBR_MANIFEST) -> DataFrame:
    """A manifest of JSON lines."""
    return spark.read.schema(schema).json(path)


def manifest_array(spark: SparkSession, path: str, schema: str = schemas.RARE_MANIFEST) -> DataFrame:
    """A manifest that is one JSON array; a corrupt file counts as empty."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path, multiLine=True)


def pool_config(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))  # one small file


def next_pool(current: str, order: list[str]) -> str | None:
    if current in P.POOL_CYCLE:
        return P.POOL_CYCLE[current] if P.POOL_CYCLE[current] in order else None
    return order[0] if order else None


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines of a file; 0 where there is none."""
    return spark.read.text(path).count() if exists(spark, path) else 0


def wav_files(spark: SparkSession, path: str) -> list[str]:
    """The *.wav files in a run's folder, in any case, empty ones too, and not below it; no folder, no files."""
    if not exists(spark, path):
        return []
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*.[wW][aA][vV]")
    return [s.getPath().toString() for s in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) if s.isFile()]


def stored_stats(path: str) -> dict:
    """The statistics of an earlier run; none if the file is missing or broken."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return {}
    return found if isinstance(found, dict) else {}


def listings(spark: SparkSession, path: str) -> DataFrame:
    """source_url, entries, error: JSON lines of what sources list."""
    return spark.read.schema("source_url string, entries array<struct<webpage_url:string,url:string>>, error string").json(path)


def infos(spark: SparkSession, path: str) -> DataFrame:
    """url, id, webpage_url, subtitles (lang and formats, in order), error: JSON lines of descriptions of videos.
    Lines with an error or without anything else have no info."""
    raw = spark.read.schema("url string, id string, webpage_url string, subtitles map<string,array<struct<ext:string,url:string>>>, error string").json(path)
    subs = F.transform(F.coalesce(F.map_entries("subtitles"), F.expr("cast(array() as array<struct<key:string,value:array<struct<ext:string,url:string>>>>)")), lambda e: F.struct(e["key"].alias("lang"), e["value"].alias("formats")))
    return raw.filter(F.col("error").isNull()).select("url", "id", "webpage_url", subs.alias("subtitles"))
