"""Writers. Distributed output goes through Spark's writers; single documents are small reports and are renamed into place."""

from __future__ import annotations

import csv
import json
import os
import textwrap
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.na.fill("").write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="")


def _into_place(path: str, write) -> None:
    temporary = f"{path}.tmp"
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(temporary, "w", encoding="utf-8", newline="") as f:
        write(f)
    os.replace(temporary, path)


def write_document(value: dict, path: str) -> None:
    _into_place(path, lambda f: f.write(json.dumps(value, ensure_ascii=False, indent=2, default=str) + "\n"))


def write_manifest(df: DataFrame, array_path: str, lines_path: str) -> None:
    """A selected manifest (bounded by its target count) as a JSON array, indented, and as JSON lines, in uid order, row
    by row. Nulls keep their keys."""
    rows = df.orderBy("uid").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()

    def both(f) -> None:
        def lines(g) -> None:
            empty = True
            for row in rows:
                value = json.loads(row[0])
                f.write(("[\n" if empty else ",\n") + textwrap.indent(json.dumps(value, ensure_ascii=False, indent=2), "  "))
                g.write(json.dumps(value, ensure_ascii=False) + "\n")
                empty = False
            f.write("[]" if empty else "\n]")

        _into_place(lines_path, lines)

    _into_place(array_path, both)


def write_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """A bounded table as one file of JSON lines, row by row."""
    rows = df.orderBy(*order).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()
    _into_place(path, lambda f: f.writelines(json.dumps(json.loads(r[0]), ensure_ascii=False) + "\n" for r in rows))


def write_sheet(df: DataFrame, path: str, order: list[str]) -> None:
    """A bounded table as one TAB-separated file with a header; nulls are empty."""

    def write(f) -> None:
        out = csv.writer(f, delimiter="\t")
        out.writerow(df.columns)
        out.writerows(["" if x is None else x for x in r] for r in df.orderBy(*order).toLocalIterator())

    _into_place(path, write)


def write_zip(files: Iterable[tuple[str, str]], path: str) -> None:
    """(source, name in the archive), stored without compression."""
    temporary = f"{path}.tmp"
    with zipfile.ZipFile(temporary, "w", compression=zipfile.ZIP_STORED) as z:
        for source, name in files:
            z.write(source, arcname=name)
    os.replace(temporary, path)
