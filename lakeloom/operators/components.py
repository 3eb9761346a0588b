"""Connected components by alternating large-star and small-star rounds.

Every round is two group-by-minimum plus equi-join steps, so a hub with very
many edges is combined map-side and its join partition can be split by AQE.
The edge set is written to the shared folder after each round; nothing of it
is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.plans.storage import discard, materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(low, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        .distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    return (
        e.join(low, "a")
        .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p"))
        .select("p.a", "p.b")
        .where(F.col("a") > F.col("b"))
        .distinct()
    )


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every end of an edge; component is the least node reached.

    Self loops keep their node; null ends are dropped; repeated edges count once.
    """
    e = edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    nodes = e.where(F.col("a") == F.col("b")).select(F.col("a").alias("node")).distinct()
    e = materialize(e.where(F.col("a") > F.col("b")).distinct(), "cc")
    loops = materialize(nodes, "cc-loops")
    before = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        old, e = e, materialize(_small_star(_large_star(e)), "cc")
        discard(old)
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    found = stars.unionByName(roots)
    return found.unionByName(loops.join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
