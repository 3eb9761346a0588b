"""Documents from their chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import split_chunk_key

#: Lines up to which an overlap between a document and its next chunk is looked for.
MAX_OVERLAP = 100


def _lines(text: Column) -> Column:
    """Lines of a text; one line break at its end makes no line."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(text, r"\R\z", ""), r"\R", -1))


def _overlap(acc: Column, new: Column) -> Column:
    """The longest n with the last n lines of ``acc`` equal to the first n of ``new``."""
    most = F.least(F.size(acc), F.size(new), F.lit(MAX_OVERLAP))
    fits = F.filter(F.sequence(F.lit(0), most), lambda n: (n > 0) & (F.element_at(acc, -1) == F.get(new, n - 1)) & (F.slice(acc, -F.greatest(n, F.lit(1)), n) == F.slice(new, 1, n)))
    return F.coalesce(F.array_max(fits), F.lit(0))


def reassemble(chunks: DataFrame) -> DataFrame:
    """(base_path, text) from (filename, text): chunks in the order of their index, overlapping lines once.

    A document of a single chunk keeps its text as it is; others are joined by line feeds.
    """
    keyed = chunks.select(split_chunk_key(F.col("filename")).alias("k"), "text")
    listed = keyed.groupBy(F.col("k.base").alias("base_path")).agg(F.sort_array(F.collect_list(F.struct(F.col("k.idx").alias("idx"), "text"))).alias("c"))
    first = _lines(F.get("c", F.lit(0))["text"])

    def add(acc: Column, c: Column) -> Column:
        pair = F.struct(acc.alias("a"), _lines(c["text"]).alias("b"))
        return F.element_at(F.transform(F.array(pair), lambda p: F.concat(p["a"], F.slice(p["b"], _overlap(p["a"], p["b"]) + 1, F.greatest(F.size(p["b"]), F.lit(1))))), 1)

    joined = F.array_join(F.aggregate(F.slice("c", F.lit(2), F.greatest(F.size("c") - 1, F.lit(0))), first, add), "\n")
    return listed.select("base_path", F.when(F.size("c") == 1, F.get("c", F.lit(0))["text"]).otherwise(joined).alias("text"))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Number of chunks, different file names, mean and total tokens."""
    return chunks.agg(
        F.count("*").alias("total_chunks"),
        F.countDistinct("filename").alias("unique_files"),
        F.coalesce(F.round(F.avg("token_count"), 2), F.lit(0.0)).alias("avg_tokens"),
        F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"),
    )


def count_documents(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.countDistinct(split_chunk_key(F.col("filename"))["base"]).alias("documents"))
