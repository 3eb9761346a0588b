"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows of equal text form a group.  Each task differences the groups of its own
hash partition: a partial partition is a vector of ``shards`` sums, and the
two vectors with the largest spread are added in opposite order until one is
left.  The driver differences the tasks' vectors in the same way: ``shards``
numbers a task, no group is ever collected.  Assignments are read off by
unwinding the merges from the last to the first.

Null texts count as empty and weigh ``ROW_BYTES``; repeated rows of a text stay
together; an empty table gives an empty result; other columns are ignored.
Ties in spread go to the partial partition that was made first.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.plans.storage import materialize

ROW_BYTES = 8
#: Share of the rows above which a group is hot; rows of the merge plan that are broadcast; rows of a shard numbered together.
HOT_SHARE, BROADCAST_ROWS, ROWS_PER_BUCKET = 1e-3, 1_000_000, 20_000


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge (n, k) partial partitions into one.

    Returns the k sums and, per input vector, an array that maps each of its
    columns to a column of the result.
    """
    n, k = vectors.shape
    if n == 0:
        return np.zeros(k, np.int64), np.zeros((0, k), np.int16)
    order = np.argsort(vectors, axis=1, kind="stable")
    sums: list[np.ndarray | None] = list(np.take_along_axis(vectors, order, 1))
    heap = [(-int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    left, right, perm = [], [], []  # of merge n + j: its parts, and how its columns were sorted
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]
        sums[a] = sums[b] = None
        by = np.argsort(total, kind="stable")
        left.append(a), right.append(b), perm.append(by.astype(np.int16))
        sums.append(total := total[by])
        heapq.heappush(heap, (-int(total[-1] - total[0]), len(sums) - 1))
    final = sums[-1]
    place: dict[int, np.ndarray] = {len(sums) - 1: np.arange(k, dtype=np.int16)}
    out = np.empty((n, k), np.int16)
    for j in range(len(left) - 1, -1, -1):
        at = place.pop(n + j)
        whole = np.empty(k, np.int16)
        whole[perm[j]] = at  # column before sorting -> result column
        place[left[j]], place[right[j]] = whole, whole[::-1]
    for i in range(n):
        out[i][order[i]] = place[i]
    return final, out


def _local(shards: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """All groups of a task: their local column, and one row with the task's sums."""
        whole = [p for p in parts if len(p)]
        if not whole:
            return
        part = pd.concat(whole, ignore_index=True).sort_values(["weight", "key"], ascending=[False, True], ignore_index=True)
        vectors = np.zeros((len(part), shards), np.int64)
        vectors[:, 0] = part["weight"]
        final, place = difference(vectors)
        yield pd.DataFrame({"key": part["key"], "part": part["part"], "column": place[:, 0].astype("int32"), "sums": None})
        yield pd.DataFrame({"key": [None], "part": [int(part["part"][0])], "column": [-1], "sums": [final.tolist()]})

    return run


def balanced_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", groups_per_task: int = 50_000) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; group weights are UTF-8 bytes plus ``ROW_BYTES`` a row.

    Groups of more than ``HOT_SHARE`` of the rows, at most as many as its reciprocal, reach their rows by a broadcast.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(
        docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("key")),
        "shard-rows",
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("weight"), F.count("*").alias("c"))
    total, different = rows.agg(F.count("*"), F.approx_count_distinct("key")).first()
    tasks = max(1, -(-different // groups_per_task))
    hot = F.col("c") > max(1, int(HOT_SHARE * total))
    frequent = groups.where(hot).select("key")
    groups = groups.drop("c")
    groups = groups.repartition(tasks, "key").withColumn("part", F.spark_partition_id())
    placed = materialize(groups.mapInPandas(_local(shards), "key binary, part int, column int, sums array<bigint>"), "shard-groups")
    tuples = placed.where("sums is not null").select("part", "sums").orderBy("part").collect()  # one vector a task
    _, at = difference(np.array([t["sums"] for t in tuples], np.int64).reshape(len(tuples), shards))
    plan = spark.createDataFrame([(t["part"], c, int(at[i, c])) for i, t in enumerate(tuples) for c in range(shards)], "part int, column int, shard int")
    if len(tuples) * shards <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    to_shard = materialize(placed.where("sums is null").join(plan, ["part", "column"]).select("key", "shard"), "shard-plan")
    few = materialize(to_shard.join(F.broadcast(frequent), "key", "left_semi"), "shard-hot")
    placed_rows = rows.join(F.broadcast(few), "key").unionByName(rows.join(F.broadcast(few), "key", "left_anti").join(to_shard, "key"))
    return with_slots(placed_rows.drop("key"), ["shard"], -(-total // (shards * ROWS_PER_BUCKET)))


def with_slots(rows: DataFrame, by: list[str], buckets: int) -> DataFrame:
    """Add a gapless ``slot`` from 0 within each ``by`` without gathering a group in one task.

    Rows fall into buckets by a hash of all columns; buckets are counted, the counts give
    each bucket's first slot, and only rows of one bucket are numbered together.
    """
    salted = rows.withColumn("bucket", F.pmod(F.xxhash64(*rows.columns), F.lit(max(1, buckets))))
    salted = materialize(salted, "slots")
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = salted.groupBy(*by, "bucket").agg(F.count("*").alias("n")).select(*by, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    number = F.row_number().over(Window.partitionBy(*by, "bucket").orderBy(*rows.columns))
    return salted.withColumn("nth", number).join(first, [*by, "bucket"]).withColumn("slot", (F.col("first") + F.col("nth") - 1).cast("long")).drop("bucket", "nth", "first")
