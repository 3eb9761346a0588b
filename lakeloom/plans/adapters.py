"""The engine's input tables, made from the synthetic star schema; each has a DuckDB twin in ``oracle``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.sources.files import line_chunks

SIZE, OVERLAP = 20, 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _path():
    return F.concat(F.lit("/data/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/doc_"), F.col("doc_id"), F.lit(".txt"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; a null text is an empty one."""
    return table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(base_path, text) of all documents."""
    return _documents(spark, sf_dir).select(_path().alias("base_path"), "text")


def docs_with_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, and a copy in capitals with doubled spaces of every tenth document."""
    d = _documents(spark, sf_dir)
    copy = d.where("doc_id % 10 = 0").select(F.concat(_path(), F.lit(".copy")).alias("base_path"), F.concat(F.lit(" "), F.replace(F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.lit(" "), F.lit("  "))).alias("text"))
    return d.select(_path().alias("base_path"), "text").unionByName(copy)


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chunk_id, filename, chunk_index, text, token_count) of all documents' overlapping line windows."""
    d = table(spark, sf_dir, "documents").select("doc_id", _path().alias("source_path"), "text")
    made = line_chunks(d, size=SIZE, overlap=OVERLAP)
    return made.select((F.col("doc_id") * 10_000_000 + F.col("chunk_index")).alias("chunk_id"), "source_path", "filename", "chunk_index", "text", "token_count")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by name and type with the orders that hold them, and suppliers."""
    l, p, s = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    order = F.array_sort(F.collect_set(F.col("l_orderkey").cast("string")))
    parts = l.join(p, l.l_partkey == p.p_partkey).groupBy(F.col("p_name").alias("name"), F.col("p_type").alias("type")).agg(
        F.min("p_partkey").alias("entity_id"), F.min("p_brand").alias("description"), F.min("l_orderkey").cast("string").alias("first_seen_document"), order.alias("documents_appeared")
    )
    supp = l.join(s, l.l_suppkey == s.s_suppkey).groupBy(F.col("s_name").alias("name")).agg(
        F.lit("supplier").alias("type"), (F.min("s_suppkey") + 10_000_000).alias("entity_id"), F.lit(None).cast("string").alias("description"), F.min("l_orderkey").cast("string").alias("first_seen_document"), order.alias("documents_appeared")
    )
    columns = ["entity_id", "name", "type", "description", "first_seen_document", "documents_appeared"]
    return parts.select(*columns).unionByName(supp.select(*columns))


def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, p, s = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    return l.join(p, l.l_partkey == p.p_partkey).join(s, l.l_suppkey == s.s_suppkey).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("relationship_id"), F.col("s_name").alias("source"), F.col("p_name").alias("target"), F.col("l_returnflag").alias("type"), F.col("l_linestatus").alias("description"), F.col("l_orderkey").cast("string").alias("document_id")
    )


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document metadata: orders and their customers."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").cast("string").alias("document_id"), F.col("c_name").alias("sender"), F.concat(F.lit("small ring"), F.when(F.col("o_orderkey") % 2 == 0, " Inc.").otherwise("")).alias("recipient"), F.col("o_orderpriority").alias("subject"), F.col("o_orderstatus").alias("reference")
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chunk_id, reply): a deterministic stand-in for a model, with fenced and broken replies."""
    w = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+", " ")), " ")
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", w.alias("w"))
    n1, n2, n3 = (F.coalesce(F.get("w", F.lit(i)), F.lit("none")) for i in range(3))
    q = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    body = q(
        '{"metadata":{"sender":"', F.col("source"), '","recipient":["', F.col("lang"), '","","', F.col("source"), '"],"subject":null,"date":"2024-01-01"},"entities":[{"name":"', n1, '","type":"person","description":"about ', n2,
        '"},{"name":" ', n2, ' ","type":"organization","description":null},{"name":"","type":"x","description":"y"}],"relationships":[{"source":"', n1, '","target":"', n2, '","type":"knows","description":"', n3,
        '"},{"source":"', n1, '","target":"","type":"t","description":null}]}',
    )
    reply = F.when(F.col("doc_id") % 7 == 0, q("Sorry, ", body)).when(F.col("doc_id") % 3 == 0, q("```json\n", body, "\n```")).otherwise(body)
    return d.select(F.col("doc_id").alias("chunk_id"), reply.alias("reply"))
