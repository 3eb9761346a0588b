"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set into powers of two.
For a partition of items of up to ``u`` shingles every document is searched in
windows of ``2u`` shingles at a stride of ``u``, so a passage of ``u`` shingles lies
whole in a window, and a containment threshold becomes a Jaccard bound that
does not shrink with the document.  The number of MinHash functions follows
from that bound and the wanted miss rate; one equal minimum makes a candidate.
Candidates are verified by the exact share of the item's shingles that the
whole document holds.

The items of one round are broadcast; a benchmark of more than ``round_shingles``
shingles is searched in several rounds, each of a bounded size.

An item of fewer than five words has one shingle, its whole sequence, and is
found only in a document of just that sequence.  Items without words, null
texts and empty texts match nothing.  Rows that repeat a doc_id or an item_id
give their rows each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.kernel import U, _series, shingle_rows, trimmed

_SCHEMA = "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double"


def _partitions(sets: list[np.ndarray], words: list[int], k: int, threshold: float, miss: float) -> list[tuple[int, list[int], np.ndarray]]:
    """(u, items, one odd multiplier for each MinHash function) of the size partitions; u is 0 for items shorter than a shingle."""
    by: dict[int, list[int]] = {}
    for i, (s, w) in enumerate(zip(sets, words, strict=True)):
        if len(s):
            by.setdefault(0 if w < k else max(16, 1 << (len(s) - 1).bit_length()), []).append(i)
    out = []
    for u, items in sorted(by.items()):
        shared = min(math.ceil(threshold * len(sets[i]) - 1e-9) / (2 * u + len(sets[i]) - math.ceil(threshold * len(sets[i]) - 1e-9)) for i in items) if u else 1.0
        n = 1 if shared >= 1 else math.ceil(math.log(miss) / math.log1p(-shared))
        out.append((u, items, _series(1000 + u, n) | U(1)))
    return out


def _minima(s: np.ndarray, at: np.ndarray, u: int, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each window, windows x functions minima)."""
    count = np.diff(at)
    if not u:
        rows = np.flatnonzero(count == 1)
        return rows, s[at[:-1][rows]][:, None] * a
    blocks = -(-count // u)
    row = np.repeat(np.arange(len(count)), blocks)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = at[:-1][row] + nth * u
    if not len(start):
        return row, np.zeros((0, len(a)), U)
    low = np.empty((len(start), len(a)), U)
    for j, x in enumerate(a):
        low[:, j] = np.minimum.reduceat(s * x, start)
    same = np.flatnonzero(row[1:] == row[:-1])
    low[same] = np.minimum(low[same], low[same + 1])
    return row, low


def _search(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, partitions, k, threshold = plan.value
        tables = []
        for u, items, a in partitions:
            low = np.stack([(sets[i][:, None] * a).min(axis=0) for i in items])
            by = np.argsort(low, axis=0, kind="stable")
            tables.append((u, np.array(items), a, by, np.take_along_axis(low, by, 0)))
        for batch in batches:
            docs = batch.column(0).to_pylist()
            out = []
            for first, _, s, at in shingle_rows(batch.column(1), k):
                pairs = set()
                for u, items, a, by, low in tables:
                    row, windows = _minima(s, at, u, a)
                    for j in range(len(a)):
                        known, w = low[:, j], windows[:, j]
                        lo = np.searchsorted(known, w)
                        hit = np.flatnonzero(known[np.minimum(lo, len(known) - 1)] == w)
                        for x in hit:
                            y = lo[x]
                            while y < len(known) and known[y] == w[x]:
                                pairs.add((int(row[x]), int(items[by[y, j]])))
                                y += 1
                for r, i in sorted(pairs):
                    shared = int(np.isin(sets[i], s[at[r] : at[r + 1]]).sum())
                    if shared >= threshold * len(sets[i]) - 1e-9:
                        out.append((docs[first + r], ids[i], len(sets[i]), shared, shared / len(sets[i])))
            if out:
                kinds = [pa.int64()] * 4 + [pa.float64()]
                columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "n_item_shingles", "n_shared", "containment"])

    return run


def _rounds(items: DataFrame, most: int) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for r in items.toLocalIterator():
        if ids and size + len(r["text"] or "") // 2 > most:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r["item_id"]), texts.append(r["text"] or "")
        size += len(r["text"] or "") // 2
    if ids:
        yield ids, texts


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: float = 0.8, miss: float = 1e-6, round_shingles: int = 1_000_000
) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) of documents that hold ``threshold`` of an item's shingles."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = spark.createDataFrame([], _SCHEMA)
    for ids, texts in _rounds(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")), round_shingles):
        sets, words = [], []
        for _, _, s, at in shingle_rows(pa.array(texts, pa.string()), k):
            sets += [np.unique(s[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        words = [len([w for w in _words(t) if w]) for t in texts]
        plan = spark.sparkContext.broadcast((ids, sets, _partitions(sets, words, k, threshold, miss), k, threshold))
        found = found.unionByName(docs.mapInArrow(trimmed(_search(plan)), _SCHEMA))
    return found


def _words(text: str) -> list[str]:
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return text.split(" ")
