"""Table sinks and schema resolution: append, guarded overwrite, upsert, delete, stage state, old and new schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write a new table; an existing one is replaced only if asked for."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def split_errors(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows without and with an error, so that one bad file leaves the others' rows."""
    return df.where(F.col(error_col).isNull()).drop(error_col), df.where(F.col(error_col).isNotNull())


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows of both; of equal keys the new one, and among the new ones the last by ``order``."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("_new"), F.desc(order)))
    return both.withColumn("_rank", rank).where("_rank = 1").drop("_new", "_rank")


def delete_like(df: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose column doesn't hold ``part``, by LIKE: letter case is ignored, ``_`` and ``%`` are wildcards."""
    return df.where(~F.coalesce(F.col(column).ilike(f"%{part}%"), F.lit(False)))


def delete_counts(df: DataFrame, column: str, part: str) -> DataFrame:
    """One row: how many rows there are, how many ``delete_like`` takes away, and how many it leaves."""
    return df.agg(F.count("*").alias("n_before"), F.count_if(F.col(column).ilike(f"%{part}%")).alias("n_deleted")).withColumn("n_after", F.col("n_before") - F.col("n_deleted"))


def stage_done(spark: SparkSession, path: str, stage: str) -> bool:
    """Whether the state table says that a stage is complete."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm):
        return False
    return not spark.read.parquet(path).where(F.col("stage") == stage).isEmpty()


def mark_stage(spark: SparkSession, path: str, stage: str, rows: int) -> None:
    spark.createDataFrame([(stage, rows)], "stage string, rows long").write.mode("append").parquet(path)


def reset_stages(spark: SparkSession, path: str, stages: list[str] | None = None) -> None:
    """Forget that these stages, or all, are complete; the table has a row a stage."""
    kept = [tuple(r) for r in spark.read.parquet(path).select("stage", "rows").collect() if stages is not None and r["stage"] not in stages]
    spark.createDataFrame(kept, "stage string, rows long").coalesce(1).write.mode("overwrite").parquet(path)


#: Present column by its older name, for tables written by an earlier generation.
RENAMED = {"documents_appeared": "chunks_appeared", "first_seen_document": "first_seen_chunk", "document_id": "chunk_id"}


def canonical(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Project a table of either generation onto ``columns`` (name to default): old names are mapped, missing ones and nulls get the default."""
    have = set(df.columns)

    def one(name: str, default: str):
        found = name if name in have else RENAMED.get(name) if RENAMED.get(name) in have else None
        return F.coalesce(F.col(found).cast("string"), F.lit(default)).alias(name) if found else F.lit(default).alias(name)

    return df.select(*[one(n, d) for n, d in columns.items()])
