"""Removal of repeated passages by sliding runs of consecutive sentences.

Every run of three sentences is hashed, and so are shorter runs of enough
words (``RUNS``), so that long sentences need no company.  Where three
sentences have too few words, as lines of lists and verse do, the run goes on
until it has enough, forwards from each sentence and backwards from each: so
every sentence of a repeated passage of three or more is covered, provided the
passage has the words of a run.  The first occurrence of a run is the one of
the least (doc_id, position); sentences that any other occurrence covers are
removed.

Within one Arrow batch all but the first occurrence of a run are surely not
the first of all: they are settled at once and go to a partition of their
document.  Only the batch's first occurrence is sent to the run's partition, so
a passage that a third of all documents share meets there once a batch.

Rows without doc_id are kept whole and not searched; null texts stay null;
rows that repeat a doc_id are copies of one document (their equal places are
one occurrence, and the first one stays in each); occurrences of one run are never
tied, since no two share doc_id and place; texts of any length are cut whole; an empty
table gives an empty result; other columns, whatever their names, are ignored.

A single sentence of ``RUNS``' last length or more counts as a run too: a passage of one
long sentence would otherwise stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.kernel import ODD, U, blocks, mix, sentences

#: Sentences in a run, and the words that such a run must have.
RUNS = ((3, 10), (2, 20), (1, 32))
#: Bits of a packed span for its number of sentences: a run has at most the least words of the longest, and a word a sentence.
_BITS = 4
_SPAN = np.dtype([("hash", "u8"), ("doc", "i8"), ("pos", "u4"), ("k", "u1")])


def _runs(h: np.ndarray, words: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, first sentence, hash) of all runs."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    for k, least in RUNS:
        n = len(h) - k + 1
        if n < 1:
            continue
        total, size = h[:n] * ODD[0], words[:n].copy()
        for j in range(1, k):
            total += h[j : n + j] * ODD[j]
            size += words[j : n + j]
        keep = np.flatnonzero((row[:n] == row[k - 1 :]) & (size >= least))
        yield k, keep, mix(total[keep] + ODD[30 + k])
    k, least = RUNS[0]
    before = np.append(0, np.cumsum(words, dtype=np.int64))
    # Sentences whose run of one less is too short, as the run's first ones or as its last.
    first = np.arange(len(h) - k + 1) if len(h) >= k else np.zeros(0, np.int64)
    first = first[before[first + k] - before[first] < least]
    while len(first):
        k += 1
        ahead = first[first + k <= len(h)]
        back = first[first > 0] - 1
        for at, new in ((ahead, True), (back, False)):
            at = at[row[at] == row[at + k - 1]]
            at = at[before[at + k] - before[at] >= least]
            if not new:  # those that also end a forward run are there already
                at = at[before[at + k - 1] - before[at] >= least]
            total = np.zeros(len(at), U)
            for j in range(k):
                total += h[at + j] * ODD[j]
            yield k, at, mix(total + ODD[30 + k])
        first = first[first + k <= len(h)]
        first = first[before[first + k] - before[first] < least]


def _spans(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held = batch.column(0), []
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(0).to_numpy()
            for first, end, data, offsets in blocks(batch.column(1)):
                h, words, _, rows = sentences(data, offsets)
                row = np.repeat(np.arange(first, end), np.diff(rows))
                for k, at, total in _runs(h, words, rows):
                    at_row = row[at]
                    e = np.empty(len(at), _SPAN)
                    e["hash"], e["doc"], e["pos"], e["k"] = total, doc[at_row], at - rows[at_row - first], k
                    held.append(e[known[at_row]])
            if not held:
                continue
            e = np.concatenate(held)
            later = _later(e := e[np.lexsort((e["pos"], e["doc"], e["hash"]))])
            to_doc = (mix(e["doc"].astype(U)) >> U(32)) * U(ranges) >> U(32)
            to_run = (e["hash"] >> U(32)) * U(ranges) >> U(32)
            yield from _packed(e[later], to_doc[later], True)
            yield from _packed(e[~later], to_run[~later], False)

    return run


def _later(e: np.ndarray) -> np.ndarray:
    """Which of the entries, sorted by hash, doc and pos, are at another place than their run's first."""
    if not len(e):
        return np.zeros(0, bool)
    first = np.append(True, e["hash"][1:] != e["hash"][:-1])
    lead = e[np.flatnonzero(first)[np.cumsum(first) - 1]]
    return (e["doc"] != lead["doc"]) | (e["pos"] != lead["pos"])


def _packed(e: np.ndarray, at: np.ndarray, settled: bool) -> Iterator[pa.RecordBatch]:
    if len(e):
        order = np.argsort(at, kind="stable")
        e, at = e[order], at[order]
        cut = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        parts = [e[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(e)), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[cut].astype(np.int32)), pa.array([settled] * len(cut)), pa.array(parts, pa.binary())], ["range", "settled", "entries"]
        )


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, packed positions) of the occurrences that are not their run's first."""
    done, held = [], {}
    for batch in batches:
        for r, settled, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            (done if settled else held.setdefault(r, [])).append(np.frombuffer(x, _SPAN))
    for r in list(held):
        e = np.concatenate(held.pop(r))
        e = e[np.lexsort((e["pos"], e["doc"], e["hash"]))]
        done.append(e[_later(e)])
    if done:
        e = np.concatenate(done)
        e = e[np.argsort(e["doc"], kind="stable")]
        cut = np.flatnonzero(np.append(True, e["doc"][1:] != e["doc"][:-1])) if len(e) else np.zeros(0, int)
        for a in range(0, len(cut), 5000):
            at = np.append(cut, len(e))[a : a + 5001]
            packed = [np.unique(e["pos"][x:y].astype(np.int64) << _BITS | e["k"][x:y]).tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(e["doc"][at[:-1]]), pa.array(packed, pa.binary())], ["doc_id", "spans"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, spans = batch.column(1), batch.column(2).to_pylist()
        n, gone, out = [], [], []
        for first, end, data, offsets in blocks(text):
            _, _, start, rows = sentences(data, offsets)
            for i in range(first, end):
                a, b = rows[i - first], rows[i - first + 1]
                lo, hi = offsets[i - first], offsets[i - first + 1]
                drop = np.zeros(b - a, bool)
                for part in spans[i] or ():
                    for x in np.frombuffer(part, np.int64):
                        drop[x >> _BITS : (x >> _BITS) + (x & (1 << _BITS) - 1)] = True
                n.append(int(b - a)), gone.append(int(drop.sum()))
                if not text[i].is_valid:
                    out.append(None)
                elif not drop.any():
                    out.append(text[i].as_py())
                else:
                    edge = np.append(start[a:b], hi)
                    kept = [data[lo : edge[0]].tobytes()] + [data[edge[j] : edge[j + 1]].tobytes() for j in np.flatnonzero(~drop)]
                    out.append(b"".join(kept).decode())
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_sentences", "n_removed", "text"])


def drop_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_sentences, n_removed and the text without sentences that a non-first repeated run covers."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    packed = docs.mapInArrow(_spans(4 * parts), "range int, settled boolean, entries binary").repartition(parts, "range")
    found = packed.mapInArrow(_settle, "doc_id long, spans binary")
    by_doc = found.groupBy("doc_id").agg(F.collect_list("spans").alias("spans"))
    # Rows without an id have no spans; they stay out of the join, where they would meet in one task.
    named = docs.where("doc_id is not null").join(by_doc, "doc_id", "left").select("doc_id", "text", "spans")
    unnamed = docs.where("doc_id is null").withColumn("spans", F.lit(None).cast("array<binary>"))
    return named.unionByName(unnamed).mapInArrow(_cut, "doc_id long, n_sentences long, n_removed long, text string")
