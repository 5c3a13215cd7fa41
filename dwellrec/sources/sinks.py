"""Sinks. Default mode is ``errorifexists``: writing twice to one path fails,
as a text-file save does."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_text(lines: DataFrame, path: str, mode: str = "errorifexists",
               compression: str | None = None) -> None:
    """One ``value`` string column → text files (one line per row)."""
    w = lines.select("value").write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
