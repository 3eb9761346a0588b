"""Entity resolution: deterministic keys, token-blocked string similarity, top-k cosine neighbours, and the rewrite.

Entities are (entity_id, name, type, description, first_seen_document, documents_appeared array);
relationships are (relationship_id, source, target, type, description, document_id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.similarity import score_pair
from lakeloom.functions.text import blocking_tokens, merge_key, normalize_name
from lakeloom.operators.components import connected_components
from lakeloom.operators.dedup import _numbered

#: Asking vectors of one block, and their values if these are more than the vectors of ``LONG_ROWS``; names of a token's block.
BLOCK_ROWS, BLOCK_VALUES, LONG_ROWS, TOKEN_ROWS = 60_000, 4_000_000, 20_000, 2_000
#: Asking and given vectors of one product.
ASK_ROWS, GIVE_ROWS = 1_024, 4_096


def _docs() -> F.Column:
    return F.coalesce(F.size("documents_appeared"), F.lit(0))


def canonical_pick(members: DataFrame, group: str) -> DataFrame:
    """Add ``rank`` (1 for the canonical): most documents, longest name, least id."""
    order = [F.desc("n_docs"), F.desc(F.length("name")), F.col("entity_id")]
    return members.withColumn("n_docs", _docs()).withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def merge_groups(entities: DataFrame) -> DataFrame:
    """Members of normalized keys that several entities share, each with the key and its canonical's name."""
    keyed = entities.withColumn("group_key", merge_key(F.col("name")))
    many = keyed.groupBy("group_key").agg(F.count("*").alias("group_size")).where("group_size > 1")
    return _with_canonical(keyed.join(many, "group_key"))


def _with_canonical(members: DataFrame) -> DataFrame:
    ranked = canonical_pick(members, "group_key")
    head = ranked.where("rank = 1").select("group_key", F.col("name").alias("canonical"))
    return ranked.join(head, "group_key")


def token_pairs(entities: DataFrame) -> DataFrame:
    """Different pairs of names (name_a < name_b) that share a blocking token and differ in their keys."""
    keyed = entities.select("name").distinct().withColumn("k", normalize_name(F.col("name")))
    tokens = keyed.withColumn("tokens", blocking_tokens(F.col("k"))).withColumn("token", F.explode(F.array_distinct("tokens")))
    shared = tokens.groupBy("token").agg(F.ceil(F.count("*") / TOKEN_ROWS).alias("blocks"), F.count("*").alias("n")).where("n > 1").drop("n")
    tokens = tokens.join(shared, "token").withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")))
    # A block meets itself and every later one, each in a task of its own: a frequent token is no hot key.
    later, before = F.sequence(F.col("own"), F.col("blocks") - 1), F.sequence(F.lit(0).cast("long"), F.col("own"))
    side = lambda s: [F.col("name").alias(f"name_{s}"), F.col("k").alias(f"key_{s}"), F.col("tokens").alias(f"tokens_{s}")]
    a = tokens.select("token", *side("a"), F.col("own").alias("i"), F.explode(later).alias("j"))
    b = tokens.select("token", *side("b"), F.explode(before).alias("i"), F.col("own").alias("j"))
    met = a.join(b, ["token", "i", "j"]).where("key_a <> key_b and (i < j or name_a < name_b)")
    # A pair belongs to the least token it shares, so it appears once.
    once = met.where(F.col("token") == F.array_min(F.array_intersect("tokens_a", "tokens_b")))
    turn = F.col("name_a") > F.col("name_b")
    swap = lambda x, y: F.when(turn, F.col(y)).otherwise(F.col(x))
    return once.select(swap("name_a", "name_b").alias("name_a"), swap("name_b", "name_a").alias("name_b"), swap("key_a", "key_b").alias("key_a"), swap("key_b", "key_a").alias("key_b"))


def scored_pairs(entities: DataFrame, threshold: float = 0.88) -> DataFrame:
    """(name_a, name_b, jw, ts, combined) of blocked pairs whose rounded score reaches the threshold."""
    s = token_pairs(entities).withColumn("s", score_pair("key_a", "key_b"))
    return s.select("name_a", "name_b", "s.jw", "s.ts", "s.combined").where(F.col("combined") >= threshold)


def cluster_pairs(entities: DataFrame, pairs: DataFrame) -> DataFrame:
    """Members of the components of name pairs, each with its canonical's name.  Names must be unique."""
    found = connected_components(pairs.select(F.col("name_a").alias("src"), F.col("name_b").alias("dst")))
    return _with_canonical(entities.join(found.select(F.col("node").alias("name"), F.col("component").alias("group_key")), "name"))


def name_map(groups: DataFrame) -> DataFrame:
    """(old, canonical) of the names that change."""
    return groups.where("name <> canonical").select(F.col("name").alias("old"), "canonical").distinct()


def merged_entities(entities: DataFrame, groups: DataFrame) -> DataFrame:
    """All entities once: groups as one row with the union of their documents and the longest description, others as they are.

    Merged rows get new ids after the largest, in the order of their first member.
    """
    best = F.max_by("description", F.struct(F.length(F.coalesce("description", F.lit(""))), -F.col("rank")))
    one = lambda c: F.max(F.when(F.col("rank") == 1, F.col(c)))
    merged = groups.groupBy("group_key").agg(
        one("name").alias("name"), one("type").alias("type"), best.alias("description"), one("first_seen_document").alias("first_seen_document"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("documents_appeared", F.array().cast("array<string>")))))).alias("documents_appeared"),
    )
    top = entities.agg(F.coalesce(F.max("entity_id"), F.lit(0)).alias("m")).first()["m"]
    heads = groups.groupBy("group_key").agg(F.min("entity_id").alias("first_id"))
    merged = merged.join(_numbered(heads, ["first_id"], "nth").drop("first_id"), "group_key").withColumn("entity_id", F.col("nth") + top + 1)
    columns = ["entity_id", "name", "type", "description", "first_seen_document", "documents_appeared"]
    rest = entities.join(groups.select("entity_id"), "entity_id", "left_anti")
    return rest.select(*columns).unionByName(merged.select(*columns))


def map_names(df: DataFrame, names: DataFrame, columns: list[str]) -> DataFrame:
    """Replace whole values by their canonical names and count the changed columns of a row in ``n_changed``."""
    out = df.withColumn("n_changed", F.lit(0))
    for c in columns:
        out = out.join(names.select(F.col("old").alias(c), F.col("canonical").alias("_to")), c, "left")
        out = out.withColumn("n_changed", F.col("n_changed") + F.col("_to").isNotNull().cast("int")).withColumn(c, F.coalesce("_to", c)).drop("_to")
    return out


def dedup_relationships(rels: DataFrame) -> DataFrame:
    """Of equal (source, target, type, document_id) the one with the least id."""
    keys = ["source", "target", "type", "document_id"]
    if set(rels.columns) == {"relationship_id", *keys}:  # nothing else to carry: no sort; a null id comes first
        least = F.when(F.count("relationship_id") == F.count("*"), F.min("relationship_id"))
        return rels.groupBy(*keys).agg(least.alias("relationship_id")).select(*rels.columns)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("relationship_id"))
    return rels.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def rewrite_stats(entities: DataFrame, merged: DataFrame, rels: DataFrame, mapped: DataFrame, final: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of counts before and after a rewrite."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    parts = [
        count(entities, "original_entities"), count(merged, "final_entities"), count(rels, "original_relationships"), count(final, "final_relationships"),
        mapped.agg(F.count_if(F.col("n_changed") > 0).alias("relationships_rewritten")), groups.agg(F.countDistinct("group_key").alias("merge_groups"), F.count("*").alias("entities_involved")),
    ]
    out = parts[0].withColumn("k", F.lit(1))
    for p in parts[1:]:
        out = out.join(p.withColumn("k", F.lit(1)), "k")
    return out.drop("k").withColumn("entities_removed", F.col("original_entities") - F.col("final_entities")).withColumn("relationships_deduped", F.col("original_relationships") - F.col("final_relationships"))


def dry_run_stats(entities: DataFrame, rels: DataFrame, groups: DataFrame) -> DataFrame:
    """The counters of ``rewrite_stats`` as a merge of these groups would leave the entities; relationships stay as they are."""
    one = entities.agg(F.count("*").alias("original_entities")).withColumn("k", F.lit(1))
    for p in (rels.agg(F.count("*").alias("original_relationships")), groups.agg(F.countDistinct("group_key").alias("merge_groups"), F.count("*").alias("entities_involved"))):
        one = one.join(p.withColumn("k", F.lit(1)), "k")
    gone = F.col("entities_involved") - F.col("merge_groups")
    return one.drop("k").withColumns(
        {"final_entities": F.col("original_entities") - gone, "entities_removed": gone, "final_relationships": F.col("original_relationships"), "relationships_rewritten": F.lit(0).cast("long"), "relationships_deduped": F.lit(0).cast("long")}
    )


def report_stats(stats: DataFrame, source: str, output: str, threshold: float | None, pairs: DataFrame, dry_run: bool = False) -> DataFrame:
    """One row: what a run read and wrote, its threshold, the counters of ``stats`` and the number of candidate pairs."""
    count = pairs.agg(F.count("*").alias("candidate_pairs")).withColumn("k", F.lit(1))
    run = {"dry_run": F.lit(dry_run), "source_db": F.lit(source), "output_db": F.lit(output), "threshold": F.lit(threshold).cast("double")}
    return stats.withColumn("k", F.lit(1)).join(count, "k").drop("k").withColumns(run)


def report_groups(groups: DataFrame) -> DataFrame:
    """(canonical, member_count, members) by size; members by rank."""
    members = F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda x: x["name"])
    return groups.groupBy("group_key", "canonical").agg(F.count("*").alias("member_count"), members.alias("members")).drop("group_key")


def merge_samples(groups: DataFrame, n: int = 10, members: int = 5) -> DataFrame:
    """(canonical, member_count, others): the ``n`` largest groups with the first other names of each, by rank."""
    order = [F.desc("member_count"), "canonical", "group_key"]
    top = groups.groupBy("group_key", "canonical").agg(F.count("*").alias("member_count")).orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy("group_key").orderBy("rank"))
    some = groups.where("name <> canonical").select("group_key", "rank", "name").join(top.select("group_key"), "group_key", "left_semi").withColumn("nth", rank).where(F.col("nth") <= members)
    listed = some.groupBy("group_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "name"))), lambda x: x["name"]).alias("others"))
    return top.join(listed, "group_key", "left").orderBy(*order).select("canonical", "member_count", F.coalesce("others", F.array().cast("array<string>")).alias("others"))


def report_pairs(pairs: DataFrame, n: int = 500) -> DataFrame:
    return pairs.orderBy(F.desc("combined"), "name_a", "name_b").limit(n)


class _Best:
    """The ``k`` most similar rows of each asking row so far.

    Products in single precision, less a bound of their error, choose the candidates; these are scored in double precision,
    each by itself, so equal vectors score alike wherever they lie.
    """

    def __init__(self, k: int, ids: np.ndarray, rows: np.ndarray, floor: float = -np.inf) -> None:
        self.k, self.ids, self.rows, self.single, self.floor = k, ids, rows, rows.astype(np.float32), floor
        self.norms, self.largest = np.linalg.norm(rows, axis=1), 0.0
        self.sims, self.found = np.full((len(ids), k), -np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)

    def meet(self, ids: np.ndarray, rows: np.ndarray) -> None:
        ids, rows = _least_copies(ids, rows, self.k + 1)
        norms = np.linalg.norm(rows, axis=1)
        norms = norms[np.isfinite(norms)]
        self.largest = max(self.largest, norms.max(initial=0.0))
        small = max(self.largest, self.norms.max(initial=0.0)) < 1e15  # else single precision could overflow
        mine, theirs = (self.single, rows.astype(np.float32)) if small else (self.rows, rows)
        slack = (rows.shape[1] + 8) * 2.0**-23 * self.norms * self.largest + rows.shape[1] * 1e-37
        for at in range(0, len(self.ids), ASK_ROWS):
            part = slice(at, at + ASK_ROWS)
            sims = mine[part] @ theirs.T
            least = np.maximum(self.sims[part, -1], self.floor) - slack[part]
            new = np.flatnonzero(np.isneginf(least))
            if len(new) and len(ids) > self.k + 1:  # one of them may be the asking row itself
                least[new] = np.partition(np.nan_to_num(sims[new], nan=-np.inf), -self.k - 1, axis=1)[:, -self.k - 1] - 2 * slack[part][new]
            i, j = _where(sims >= least.astype(sims.dtype)[:, None])
            other = self.ids[i + at] != ids[j]
            i, j = i[other], j[other]
            for some in np.array_split(np.arange(len(i)), max(1, -(-len(i) // 100_000))):
                if len(some):
                    self._take(i[some] + at, ids[j[some]], (self.rows[i[some] + at] * rows[j[some]]).sum(axis=1))

    def _take(self, row: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        keep = np.isfinite(sims) & (sims >= self.sims[row, -1])
        row, ids, sims = row[keep], ids[keep], sims[keep]
        had = np.unique(row)
        row, ids, sims = np.append(np.repeat(had, self.k), row), np.append(self.found[had].ravel(), ids), np.append(self.sims[had].ravel(), sims)
        order = np.lexsort((ids, -sims, row))  # ties to the lesser id
        row, ids, sims = row[order], ids[order], sims[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = rank < self.k
        self.found[row[best], rank[best]], self.sims[row[best], rank[best]] = ids[best], sims[best]

    def batch(self) -> pa.RecordBatch:
        keep = np.isfinite(self.sims)
        i, rank = np.nonzero(keep)
        return pa.RecordBatch.from_arrays([pa.array(self.ids[i]), pa.array(self.found[keep]), pa.array(self.sims[keep]), pa.array((rank + 1).astype(np.int32))], ["i", "j", "sim", "rank"])


def _where(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true values, sought eight at a time."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    near = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    near = np.append(near, np.arange(whole, len(flat)))
    return np.divmod(near[flat[near]], mask.shape[1])


def _least_copies(ids: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors those with the ``n`` least ids: more can be nobody's neighbours."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], np.ascontiguousarray(rows[order])
    _, of = np.unique(rows.view(f"V{rows.itemsize * rows.shape[1]}").ravel(), return_inverse=True) if rows.shape[1] else (None, np.zeros(len(ids), np.int64))
    order = np.argsort(of, kind="stable")
    of = of[order]
    keep = np.sort(order[np.arange(len(of)) - np.searchsorted(of, of) < n])
    return ids[keep], rows[keep]


def _top(k: int, floor: float = -np.inf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ``k`` best of all vectors for those of one block, which come first."""
        asks, best = [], None
        for batch in batches:
            ids, v, ask = (batch.column(batch.schema.get_field_index(c)) for c in ("id", "v", "asks"))
            if not batch.num_rows:
                continue
            ids, ask = ids.to_numpy(), ask.to_numpy(zero_copy_only=False)
            rows = np.asarray(v.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(ids), -1)
            if ask.any():
                asks.append((ids[ask], rows[ask]))
            if ask.all():
                continue
            if best is None:
                if not asks:
                    return
                best = _Best(k, *(np.concatenate(x) for x in zip(*asks, strict=True)), floor)
            ids, rows = ids[~ask], rows[~ask]
            for at in range(0, len(ids), GIVE_ROWS):
                best.meet(ids[at : at + GIVE_ROWS], rows[at : at + GIVE_ROWS])
        if best is not None:
            yield best.batch()

    return run


def topk_neighbours(vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", floor: float = -np.inf) -> DataFrame:
    """(i, j, sim, rank): the ``k`` most similar other rows of every row, ties to the lesser id.

    Rows fall into blocks of at most about ``BLOCK_ROWS`` asking vectors by a hash of their id; all vectors stream past each block in a
    task, which keeps its ``k`` best, so memory is bounded and nothing passes through the driver.  Of neighbours less similar
    than ``floor`` some may be left out; the others and their ranks are the same.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("v is not null and id is not null")
    tasks = v.sparkSession.sparkContext.defaultParallelism
    n, size = v.agg(F.count("*"), F.max(F.size("v"))).first()
    rows = min(BLOCK_ROWS, max(LONG_ROWS, BLOCK_VALUES // max(size or 1, 1)))
    blocks = tasks * max(1, -(-n // (rows * tasks)))
    own, every = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asks = v.select("id", "v", own.alias("x"), F.lit(True).alias("asks"))
    gives = v.select("id", "v", every.alias("x"), F.lit(False).alias("asks"))
    met = asks.unionByName(gives).repartitionById(blocks, F.col("x")).sortWithinPartitions(F.desc("asks"))
    return met.mapInArrow(_top(k, floor), "i long, j long, sim double, rank int")


def neighbour_pairs(vectors: DataFrame, threshold: float = 0.82, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(i, j, sim) with i < j where j is among i's neighbours and their cosine reaches the threshold."""
    return topk_neighbours(vectors, k, id_col, vector_col, floor=threshold).where((F.col("j") > F.col("i")) & (F.col("sim") >= threshold)).select("i", "j", F.round("sim", 4).alias("sim"))
