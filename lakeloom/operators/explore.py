"""Folder roll-ups over chunk tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import strip_drive


def file_stats(chunks: DataFrame) -> DataFrame:
    """(path, chunks, tokens) of each source file."""
    return chunks.groupBy(strip_drive(F.col("filename")).alias("path")).agg(F.count("*").alias("chunks"), F.sum(F.coalesce("token_count", F.lit(0))).alias("tokens"))


def children(stats: DataFrame, prefix: list[str]) -> DataFrame:
    """(name, is_folder, files, chunks, tokens) of the next path segments below ``prefix``."""
    depth = len(prefix)
    parts = stats.withColumn("p", F.split("path", "/")).where(F.size("p") > depth)
    if depth:
        parts = parts.where(F.slice("p", 1, depth) == F.array(*[F.lit(x) for x in prefix]))
    return parts.groupBy(F.get("p", F.lit(depth)).alias("name")).agg(
        F.max(F.size("p") > depth + 1).alias("is_folder"), F.count("*").alias("files"), F.sum("chunks").alias("chunks"), F.sum("tokens").alias("tokens")
    )


def auto_skip(stats: DataFrame, prefix: list[str] | None = None) -> list[str]:
    """Descend while there is just one child and it is a folder; each step reads two rows."""
    at = list(prefix or [])
    while True:
        found = children(stats, at).limit(2).collect()
        if len(found) != 1 or not found[0]["is_folder"]:
            return at
        at.append(found[0]["name"])
