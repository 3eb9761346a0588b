"""Structured extraction: replies of a pluggable model become documents, entities, relationships and a log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import normalize_field, strip_code_fence
from lakeloom.sources.files import map_texts

FIELDS = ["sender", "recipient", "cc", "bcc", "date", "subject", "reference"]
REPLY = (
    "metadata struct<" + ", ".join(f"{f}: string" for f in FIELDS) + ">, "
    "entities array<struct<name: string, type: string, description: string>>, "
    "relationships array<struct<source: string, target: string, type: string, description: string>>"
)


def ask(chunks: DataFrame, model: Callable[[list[str]], list[str]], text_col: str = "text") -> DataFrame:
    """Add ``reply``, the model's answer to each text, and ``error``, what the model raised for it, else null."""
    return map_texts(chunks, text_col, "reply", model, "string", error_col="error")


def parse_replies(replies: DataFrame) -> DataFrame:
    """Add ``parsed``, null where the reply is no JSON object; such a reply counts as a success without content."""
    return replies.withColumn("parsed", F.from_json(strip_code_fence(F.col("reply")), REPLY, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))


def resume_docs(chunks: DataFrame, log: DataFrame) -> DataFrame:
    """Chunks that the log doesn't name as done."""
    done = log.where("success").select(F.col("document_id").alias("_done")).distinct()
    return chunks.join(done, F.col("chunk_id").cast("string") == F.col("_done"), "left_anti")


def _answered(parsed: DataFrame) -> DataFrame:
    """The rows whose extraction did not fail; a failed one leaves its log row only."""
    return parsed.where("error is null") if "error" in parsed.columns else parsed


def documents(parsed: DataFrame) -> DataFrame:
    return _answered(parsed).select(F.col("chunk_id").cast("string").alias("document_id"), *[normalize_field(F.col(f"parsed.metadata.{f}")).alias(f) for f in FIELDS])


def _given(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def mentions(parsed: DataFrame) -> DataFrame:
    """One row an entity of a reply; name and type must not be empty before they are trimmed."""
    e = _answered(parsed).select("chunk_id", F.posexplode("parsed.entities").alias("nth", "e"))
    e = e.where(_given(F.col("e.name")) & _given(F.col("e.type")))
    return e.select("chunk_id", "nth", F.trim("e.name").alias("name"), F.trim("e.type").alias("type"), F.trim(F.coalesce("e.description", F.lit(""))).alias("description"))


def fold_entities(found: DataFrame) -> DataFrame:
    """(name, type): description and document of the first mention, and the documents in order of appearance."""
    order = F.struct("chunk_id", "nth")
    seen = F.transform(F.array_sort(F.collect_set("chunk_id")), lambda x: x.cast("string"))
    return found.groupBy("name", "type").agg(F.min_by("description", order).alias("description"), F.min("chunk_id").cast("string").alias("first_seen_document"), seen.alias("documents_appeared"))


def relationships(parsed: DataFrame) -> DataFrame:
    r = _answered(parsed).select("chunk_id", F.posexplode("parsed.relationships").alias("nth", "r"))
    r = r.where(_given(F.col("r.source")) & _given(F.col("r.target")) & _given(F.col("r.type")))
    text = lambda c: F.trim(F.coalesce(f"r.{c}", F.lit("")))
    return r.select("nth", *[text(c).alias(c) for c in ("source", "target", "type", "description")], F.col("chunk_id").cast("string").alias("document_id"))


def processing_log(parsed: DataFrame) -> DataFrame:
    """A row a document: whether the model answered, what it raised if not, and whether its reply could be read."""
    error = F.col("error") if "error" in parsed.columns else F.lit(None).cast("string")
    readable = error.isNull() & F.col("parsed.entities").isNotNull()
    return parsed.select(F.col("chunk_id").cast("string").alias("document_id"), error.isNull().alias("success"), error.alias("error_message"), readable.alias("readable"))


def extract_stats(docs: DataFrame, entities: DataFrame, rels: DataFrame) -> DataFrame:
    """Counts of the three tables, and of different senders and recipients."""
    d = docs.agg(F.count("*").alias("documents"), *[F.countDistinct(F.when(_given(F.col(c)), F.col(c))).alias(f"{c}s") for c in ("sender", "recipient")])
    return d.withColumn("k", F.lit(1)).join(entities.agg(F.count("*").alias("entities")).withColumn("k", F.lit(1)), "k").join(rels.agg(F.count("*").alias("relationships")).withColumn("k", F.lit(1)), "k").drop("k")
