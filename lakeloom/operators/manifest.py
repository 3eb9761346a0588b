"""The manifest: which document of each cluster to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.components import connected_components
from lakeloom.operators.dedup import _numbered


def dedup_manifest(docs: DataFrame, groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """(base_path, cluster, is_representative, duplicate_of, source) of every document.

    Hash groups (a star around their first path) and pairs link documents; the shortest path, then the least, represents
    a cluster.  ``source`` is hash, else lsh, else null.  ``cluster`` is the least path: a label that no run changes.
    """
    stars = groups.select(F.col("first_path").alias("src"), F.col("base_path").alias("dst"))
    found = connected_components(stars.unionByName(pairs.select(F.col("path_a").alias("src"), F.col("path_b").alias("dst"))))
    all_docs = docs.select("base_path").join(found.withColumnRenamed("node", "base_path"), "base_path", "left").withColumn("cluster", F.coalesce("component", "base_path"))
    rep = all_docs.groupBy("cluster").agg(F.min(F.struct(F.length("base_path"), F.col("base_path"))).getField("base_path").alias("rep"))
    tags = groups.select("base_path", F.lit(0).alias("rank")).union(pairs.select(F.explode(F.array("path_a", "path_b")), F.lit(1)))
    tags = tags.groupBy("base_path").agg(F.min("rank").alias("rank"))
    out = all_docs.join(rep, "cluster").join(tags, "base_path", "left")
    first = F.col("base_path") == F.col("rep")
    return out.select(
        "base_path", "cluster", first.alias("is_representative"), F.when(~first, F.col("rep")).alias("duplicate_of"), F.when(F.col("rank") == 0, "hash").when(F.col("rank") == 1, "lsh").alias("source")
    )


def with_cluster_ids(manifest: DataFrame) -> DataFrame:
    """Number the clusters from 0 by their least path."""
    ids = _numbered(manifest.select("cluster").distinct(), ["cluster"], "cluster_id")
    return manifest.join(ids, "cluster")


def cluster_histogram(manifest: DataFrame) -> DataFrame:
    n = F.col("size")
    bucket = F.when(n == 1, "1").when(n <= 5, "2-5").when(n <= 20, "6-20").when(n <= 100, "21-100").otherwise("100+")
    return manifest.groupBy("cluster").agg(F.count("*").alias("size")).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_clusters"))


def largest_clusters(manifest: DataFrame, n: int = 10) -> DataFrame:
    sizes = manifest.groupBy("cluster").agg(F.count("*").alias("size"), F.max(F.when(F.col("is_representative"), F.col("base_path"))).alias("representative"))
    return sizes.orderBy(F.desc("size"), F.desc("representative")).limit(n).select("representative", "size")


def dedup_summary(manifest: DataFrame) -> DataFrame:
    """Totals and the share that goes; null for an empty corpus."""
    keep = F.count_if("is_representative")
    return manifest.agg(
        F.count("*").alias("total_docs"), F.countDistinct("cluster").alias("n_clusters"), keep.alias("keep"), (F.count("*") - keep).alias("drop"), F.round(F.try_divide(100.0 * (F.count("*") - keep), F.count("*")), 1).alias("reduction_pct")
    )


def status_flagged(groups: DataFrame, embed_pairs: DataFrame) -> DataFrame:
    """Different documents that a hash group or an embedding pair names."""
    named = groups.select("base_path").union(embed_pairs.select(F.explode(F.array("path_a", "path_b"))))
    return named.agg(F.countDistinct("base_path").alias("flagged"))
