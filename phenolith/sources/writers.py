"""Writers of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_results(df: DataFrame, base: str, kind: str = "csv", files: int = 1) -> list[str]:
    """Write df as CSV, JSON lines or both, beside base without its suffix; CSV begins with a byte order mark in its header, which spreadsheets look for."""
    if kind not in ("csv", "json", "both"):
        raise ValueError("kind is csv, json or both")
    folder, _, name = base.rpartition("/")
    stem = f"{folder}/{name.rpartition('.')[0] or name}" if folder else name.rpartition(".")[0] or name
    out = []
    if kind in ("csv", "both"):
        marked = df.withColumnRenamed(df.columns[0], f"﻿{df.columns[0]}")
        marked.coalesce(files).write.mode("overwrite").csv(f"{stem}.csv", header=True, escape='"', quoteAll=False)
        out.append(f"{stem}.csv")
    if kind in ("json", "both"):
        df.coalesce(files).write.mode("overwrite").json(f"{stem}.json", ignoreNullFields=False)
        out.append(f"{stem}.json")
    return out


def gene_file_name(taxon: str, gene: str) -> str:
    return f"GenoTy_{taxon}_{gene}.csv".replace(" ", "_").replace("/", "-")


def save_if_any(df: DataFrame, path: str) -> bool:
    """Write a CSV table, or nothing if there are no rows."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").csv(path, header=True, escape='"')
    return True


def save_lines(lines: DataFrame, path: str) -> None:
    """(line_no, value) as text in line order: range-partitioned files, each sorted."""
    lines.repartitionByRange(F.col("line_no")).sortWithinPartitions("line_no").select("value").write.mode("overwrite").text(path)
