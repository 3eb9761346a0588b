"""Exact n-gram Jaccard join by globally ordered sets, prefix buckets and a prefix tree.

A document's set holds its different five-word shingles as 64-bit hashes.
Equal sets are one class, represented by its least document.  Sets are
ordered globally, rare shingles first: by the level of load of a counter in a
hashed sketch over all documents (its size follows the input up to a fixed
one), then by hash.  Two sets of Jaccard ``threshold`` or more share a token
among their first ``n - ceil(threshold n) + 1``, so only these are shuffled,
packed by token range; a task streams its ranges.

Buckets of up to ``bucket`` classes are paired, and only pairs of fitting sizes
leave the task for which the token can be the first they share: what stands
before it on either side is lost, and the rest must still hold the overlap.
A larger bucket gives the star of a leader first.  Where its members are still of
different components, they are compared with the member of most large buckets,
and what then is left, tile by tile: members outside the largest component
against all others, so a bucket of few strangers costs its size times theirs.
No pairs leave a tile, and no link between different components is missed:
pairs inside a component change nothing.

Candidates are verified exactly.  The candidates of one probe are stored in a
prefix tree of their ordered sets; a descent carries the overlap of the shared
part, and leaves a subtree when the overlap and what remains of either side
cannot reach the needed overlap.

Nulls and empty texts have no shingles and link with nothing; rows without an
id get no component; rows that repeat an id are one document whose links are
the union of theirs; ties in the order go by hash; texts of any length are used
whole; an empty table gives an empty result; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.kernel import U, distinct_sorted, mix, shingle_rows, trimmed
from lakeloom.operators.components import connected_components
from lakeloom.plans.storage import discard, materialize

#: Bits of the sketch's size, least and most, and of one shuffled chunk; levels of load that order the shingles.
SKETCH_BITS, CHUNK_BITS, LEVELS = (18, 24), 16, 16
BUCKET = 16
#: Bytes of text for each partition of prefixes, whose entries take about as many.
PREFIX_BYTES = 64 << 20
#: Ids of 8 bytes up to which the candidates are broadcast to the scan; beyond, the texts are shuffled to them.
BROADCAST_IDS = 1_000_000
#: A class of more than this share of the documents is broadcast to its copies: at most as many classes as the reciprocal.
HOT_SHARE = 1e-3
_HEAD = np.dtype([("doc", "i8"), ("print", "i8"), ("n", "u4"), ("count", "u4")])
#: The first 48 bits of the token's hash, and its place in the document's order, at most 65535: both only widen the candidates.
_ENTRY = np.dtype([("high", "u4"), ("low", "u2"), ("pos", "u2")])


def _prints(u: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit fingerprints of a set."""
    a = int(mix(u ^ U(0xA0761D6478BD642F)).sum(dtype=U)) if len(u) else 0
    b = int(mix(u + U(0xE7037ED1A0B428DB)).sum(dtype=U)) if len(u) else 0
    return a - (a >> 63 << 64), b - (b >> 63 << 64)


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for first, _, s, at in shingle_rows(batch.column(1), k):
            for i, u in enumerate(distinct_sorted(s, at)):
                yield ids[first + i], u


def _describe(k: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, then the task's part of the sketch; equal sets of a task count once there."""
        counts, seen = np.zeros(1 << bits, np.uint32), set()
        for batch in batches:
            ids, n, f1, f2, fresh = [], [], [], [], []
            for doc, u in _sets(iter([batch]), k):
                a, b = _prints(u)
                ids.append(doc), n.append(len(u)), f1.append(a), f2.append(b)
                if (a, b) not in seen and len(u):
                    seen.add((a, b))
                    fresh.append((u >> U(64 - bits)).astype(np.intp))
            if fresh:
                np.add.at(counts, np.concatenate(fresh), 1)
            yield _batch(ids, n, f1, f2, [None] * len(ids))
        zstd = pa.Codec("zstd")
        for i, c in enumerate(counts.reshape(-1, 1 << CHUNK_BITS)):
            if c.any():
                yield _batch([None], [i], [None], [None], [zstd.compress(np.minimum(c, 255).astype(np.uint8).tobytes(), asbytes=True)])

    return run


def _batch(ids, n, f1, f2, sketch) -> pa.RecordBatch:
    columns = [pa.array(x, pa.int64()) for x in (ids, n, f1, f2)] + [pa.array(sketch, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "f1", "f2", "sketch"])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(chunk, loads of its counters) of the chunks of a partition."""
    zstd, sums = pa.Codec("zstd"), {}
    for batch in batches:
        for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums.setdefault(i, np.zeros(1 << CHUNK_BITS, np.uint64))
            sums[i] += np.frombuffer(zstd.decompress(part, 1 << CHUNK_BITS), np.uint8)
    yield from sums.items()


def _levels(described: DataFrame, bits: int, parts: int) -> np.ndarray:
    """The level of load of each counter, from 0 for the least, two in a byte: at most ``1 << SKETCH_BITS[1] - 1`` bytes.

    Counters are hashed, so the loads of one chunk are a fair sample of all: their quantiles part the levels.
    """
    rows = described.where("sketch is not null").select("n", "sketch").repartition(max(1, min(parts, 1 << (bits - CHUNK_BITS))), "n")

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, load in _add_up(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.quantile(load, np.arange(1, LEVELS) / LEVELS))], ["cut"])

    found = np.array([r["cut"] for r in rows.where("n = 0").mapInArrow(trimmed(cuts), "cut double").collect()])

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, load in _add_up(batches):
            level = np.searchsorted(found, load).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([(level[::2] | level[1::2] << 4).tobytes()], pa.binary())], ["chunk", "level"])

    out = np.zeros((1 << (bits - CHUNK_BITS), 1 << (CHUNK_BITS - 1)), np.uint8)
    for r in rows.mapInArrow(trimmed(levels), "chunk long, level binary").collect():
        out[r["chunk"]] = np.frombuffer(r["level"], np.uint8)
    return out.reshape(-1)


def _prefixes(k: int, num: int, den: int, ranges: int, bits: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packed prefix entries by token range; equal sets of a task are entered once."""
        level = levels.value
        seen, held, heads, size = set(), [], [], 0
        for doc, u in _sets(batches, k):
            prints = _prints(u)
            if doc is None or not len(u) or prints in seen:
                continue
            seen.add(prints)
            n = len(u)
            p = n + (-num * n) // den + 1  # n - ceil(threshold n) + 1
            at = (u >> U(64 - bits)).astype(np.intp)
            e = np.empty(p, _ENTRY)
            token = u[np.argsort(level[at >> 1] >> ((at & 1) << 2).astype(np.uint8) & 15, kind="stable")[:p]]
            e["high"], e["low"], e["pos"] = token >> U(32), token >> U(16) & U(65535), np.minimum(np.arange(p), 65535)
            held.append(e), heads.append((doc, prints[0], n, p))
            size += p
            if size > 1 << 20:
                yield _pack(held, heads, ranges)
                held, heads, size = [], [], 0
        if held:
            yield _pack(held, heads, ranges)

    return run


def _pack(held: list[np.ndarray], heads: list[tuple], ranges: int) -> pa.RecordBatch:
    """A row for each token range: the documents with entries there, and the entries in the documents' order."""
    e, heads = np.concatenate(held), np.array(heads, _HEAD)
    at = (e["high"].astype(U) * U(ranges) >> U(32)).astype(np.int64)
    row = np.repeat(np.arange(len(heads)), heads["count"])
    order = np.argsort(at, kind="stable")
    at, row, e = at[order], row[order], e[order]
    cut = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    first, entries = [], []
    for a, b in zip(cut, np.append(cut[1:], len(e)), strict=True):
        own, count = np.unique(row[a:b], return_counts=True)
        h = heads[own]
        h["count"] = count
        first.append(_by_byte(h)), entries.append(_by_byte(e[a:b]))
    return pa.RecordBatch.from_arrays([pa.array(at[cut].astype(np.int32)), pa.array(first, pa.binary()), pa.array(entries, pa.binary())], ["range", "heads", "entries"])


def _by_byte(x: np.ndarray) -> bytes:
    """All first bytes of the records, then all second ones and so on: the shuffle's compression finds the zeros."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _of_bytes(parts: list[bytes], kind: np.dtype) -> np.ndarray:
    return np.concatenate([np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(kind.itemsize, -1).T).reshape(-1).view(kind) for x in parts])


def _fits(n: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    return den * np.minimum(n, m).astype(np.int64) >= num * np.maximum(n, m).astype(np.int64)


_PAIRS = "token long, a long, b long, n long"


def _pair_batch(token, a, b, n) -> pa.RecordBatch:
    columns = [pa.nulls(len(a), pa.int64()) if x is None else pa.array(np.asarray(x).astype(np.int64)) for x in (token, a, b, n)]
    return pa.RecordBatch.from_arrays(columns, ["token", "a", "b", "n"])


def _ordered(e: np.ndarray, x: np.ndarray, y: np.ndarray, num: int, den: int, first: bool) -> np.ndarray:
    """Pairs of the entries ``x`` and ``y`` of fitting sizes as rows (a, b), a the lesser id.

    ``first``: only those that can still reach the needed overlap if this is the first token they share:
    what stands before it in either order is lost.
    """
    n, m = e["n"][x].astype(np.int64), e["n"][y].astype(np.int64)
    ok = _fits(n, m, num, den) & (e["doc"][x] != e["doc"][y])
    if first:
        need = -(-num * (n + m) // (num + den))
        ok &= (e["pos"][x] <= n - need) & (e["pos"][y] <= m - need)
    a, b = e["doc"][x[ok]], e["doc"][y[ok]]
    return np.stack([np.minimum(a, b), np.maximum(a, b)], 1)


def _entries(table: pa.Table) -> np.ndarray:
    """The entries of one token range with their documents' data."""
    heads = _of_bytes(table["heads"].to_pylist(), _HEAD)
    e = _of_bytes(table["entries"].to_pylist(), _ENTRY)
    out = np.empty(len(e), np.dtype([("token", "u8"), ("pos", "u4"), ("doc", "i8"), ("print", "i8"), ("n", "u4")]))
    out["token"], out["pos"] = e["high"].astype(U) << U(16) | e["low"], e["pos"]
    row = np.repeat(np.arange(len(heads)), heads["count"])
    for c in ("doc", "print", "n"):
        out[c] = heads[c][row]
    return out


def _candidates(num: int, den: int, bucket: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with a token are members of large buckets, with the sizes of their sets.  The others are pairs (a, b):
        of small buckets, those whose first shared token this can be, and of large buckets the star of one member."""
        for _, table in _groups(batches, ["range"]):
            e = _entries(table)
            e = e[np.argsort(e["token"], kind="stable")]
            shared = np.zeros(len(e), bool)
            same = e["token"][1:] == e["token"][:-1]
            shared[1:] |= same
            shared[:-1] |= same
            e = e[shared]
            e = e[np.lexsort((e["doc"], e["print"], e["token"]))]
            if not len(e):
                continue
            fresh = np.ones(len(e), bool)
            fresh[1:] = (e["token"][1:] != e["token"][:-1]) | (e["print"][1:] != e["print"][:-1])
            e = e[fresh]
            first = np.flatnonzero(np.append(True, e["token"][1:] != e["token"][:-1]))
            size = np.diff(np.append(first, len(e)))
            found = []
            for m in np.unique(size[(size > 1) & (size <= bucket)]):
                left, right = np.triu_indices(m, 1)
                at = first[size == m]
                for block in np.array_split(at, max(1, len(at) * len(left) // 500_000)):
                    found.append(np.unique(_ordered(e, (block[:, None] + left).ravel(), (block[:, None] + right).ravel(), num, den, True), axis=0))
            for at, m in zip(first[size > bucket], size[size > bucket], strict=True):
                members = np.arange(at, at + m)
                lead = members[np.argmin(mix(e["doc"][members].astype(U)))]
                found.append(_ordered(e, np.repeat(lead, m), members, num, den, False))
                yield _pair_batch(np.repeat(e["token"][at : at + 1].view(np.int64), m), e["doc"][members], None, e["n"][members])
            if found and len(pairs := np.unique(np.concatenate(found), axis=0)):
                yield _pair_batch(None, *pairs.T, None)

    return run


def _cells(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links between different components among the members of a tile pair; rows come sorted by anchor and tile pair.

        Members of all components but the largest probe a prefix tree of the others; what a link has joined is left out from then on.
        """
        for (_, i, j), g in _groups(batches, ["anchor", "i", "j"]):
            rep, n, label, tile = (np.array(g[c].to_numpy(zero_copy_only=False)) for c in ("rep", "n", "label", "tile"))
            sets = [np.frombuffer(s, U) for s in g["tokens"].to_pylist()]
            names, label, size = np.unique(label, return_inverse=True, return_counts=True)
            joined = np.arange(len(names))
            done = np.zeros(len(rep), bool)
            src, dst = [], []
            for x in np.argsort(size[label], kind="stable"):
                if label[x] == int(size.argmax()):
                    continue
                done[x] = True
                fit = np.flatnonzero(~done & (joined[label] != joined[label[x]]) & _fits(np.repeat(n[x], len(n)), n, num, den) & ((tile != tile[x]) | (i == j)))
                for y in tree_join(sets[x], [sets[k] for k in fit], num, den) if len(fit) else ():
                    y = fit[y]
                    if joined[label[y]] != joined[label[x]]:
                        joined[joined == joined[label[y]]] = joined[label[x]]
                        src.append(rep[x]), dst.append(rep[y])
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys of a sorted stream, across batch borders."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        for a, b in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
            at = tuple(c[a] for c in columns)
            if key is not None and at != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = at
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def tree_join(x: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[int]:
    """Which of ``sets`` (ascending hashes) have Jaccard ``num / den`` or more with ``x``: one descent of their prefix tree."""
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    seq = [sets[i] for i in order]
    size = np.array([len(s) for s in seq])
    need = -(-num * (len(x) + size) // (num + den))
    found, stack = [], [(0, len(seq), 0, 0)]
    while stack:
        lo, hi, depth, overlap = stack.pop()
        low, high = seq[lo], seq[hi - 1]
        m = min(len(low), len(high))
        differ = np.flatnonzero(low[depth:m] != high[depth:m])
        end = depth + int(differ[0]) if len(differ) else m
        edge = low[depth:end]
        left = len(x)
        if end:
            left -= int(np.searchsorted(x, low[end - 1], "right"))
        if len(edge):
            at = np.searchsorted(x, edge)
            overlap += int((x[np.minimum(at, len(x) - 1)] == edge).sum()) if len(x) else 0
        if overlap + min(int(size[lo:hi].max()) - end, left) < need[lo:hi].min():
            continue
        while lo < hi and size[lo] == end:  # sets that end here
            if den * overlap >= num * (len(x) + end - overlap):
                found.append(order[lo])
            lo += 1
        if lo < hi:
            heads = np.array([s[end] for s in seq[lo:hi]])
            cut = np.flatnonzero(np.append(True, heads[1:] != heads[:-1]))
            stack += [(lo + a, lo + b, end, overlap) for a, b in zip(cut, np.append(cut[1:], hi - lo), strict=True)]
    return found


def _verify(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (a, _), g in _groups(batches, ["a", "salt"]):
            ids = g["b"].to_pylist()
            sets = [np.frombuffer(s, U) for s in g["tokens"].to_pylist()]
            probes = [s for i, s in zip(ids, sets, strict=True) if i is None]
            others = [(i, s) for i, s in zip(ids, sets, strict=True) if i is not None]
            hits = sorted({others[i][0] for x in probes for i in tree_join(x, [s for _, s in others], num, den)})
            if hits:
                yield pa.RecordBatch.from_arrays([pa.array([a] * len(hits), pa.int64()), pa.array(hits, pa.int64())], ["src", "dst"])

    return run


def _pack_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = list(_sets(iter([batch]), k))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in got], pa.int64()), pa.array([u.tobytes() for _, u in got], pa.binary())], ["doc_id", "tokens"])

    return run


def _sets_of(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc_id, tokens): the packed sets of some documents."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return materialize(docs.join(ids, "doc_id", "left_semi").mapInArrow(trimmed(_pack_sets(k)), "doc_id long, tokens binary"), "jaccard-tokens")


def _send_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row with the set for each group that a document takes part in, as its probe (b is null) or as a member."""
        for batch in batches:
            roles, a, salt, b, tokens = batch.column(2).to_pylist(), [], [], [], []
            for (_, u), own in zip(_sets(iter([batch]), k), roles, strict=True):
                packed = u.tobytes()
                for r in own:
                    a.append(r["a"]), salt.append(r["salt"]), b.append(r["b"]), tokens.append(packed)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, salt, b)] + [pa.array(tokens, pa.binary())], ["a", "salt", "b", "tokens"])

    return run


def _links(pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int, group: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, verified by prefix trees of at most about ``group`` sets.

    The side with more pairs probes, so a set travels once for each pair and once for each group it probes.
    """
    pairs = materialize(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-pairs")
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("m"))
    degree, total = materialize(degree, "jaccard-degrees"), pairs.count()
    at = lambda c: degree.select(F.col("node").alias(c), F.col("m").alias(f"m_{c}"), F.col("m").alias("c"))
    turn = F.col("m_b") > F.col("m_a")
    probe, member = F.when(turn, F.col("b")).otherwise(F.col("a")), F.when(turn, F.col("a")).otherwise(F.col("b"))
    salt = F.pmod(F.xxhash64("b"), F.ceil(F.col("m") / group)).cast("long")
    known = _attached(_attached(pairs, at("a"), ["a"], total), at("b"), ["b"], total)
    salted = materialize(known.select(probe.alias("a"), member.alias("b"), F.greatest("m_a", "m_b").alias("m")).select("a", salt.alias("salt"), "b"), "jaccard-salted")
    # A member's roles are at most its partners in buckets; a probe's are parted, so no list grows with a group.
    members = salted.select(F.col("b").alias("doc_id"), F.lit(-1).cast("long").alias("part"), F.struct("a", "salt", "b").alias("role"))
    probes = salted.select("a", "salt").distinct().select(F.col("a").alias("doc_id"), F.floor(F.col("salt") / 1024).alias("part"), F.struct("a", "salt", F.lit(None).cast("long").alias("b")).alias("role"))
    roles = members.unionByName(probes).groupBy("doc_id", "part").agg(F.collect_list("role").alias("roles")).drop("part")
    if salted.count() <= BROADCAST_IDS // 4:  # two roles of 24 bytes a pair
        roles = F.broadcast(roles)
    sent = docs.join(roles, "doc_id").select("doc_id", "text", "roles").mapInArrow(trimmed(_send_sets(k)), "a long, salt long, b long, tokens binary")
    found = materialize(sent.repartition("a", "salt").sortWithinPartitions("a", "salt").mapInArrow(trimmed(_verify(num, den)), "src long, dst long"), "jaccard-links")
    discard(pairs, degree, salted)
    return found


def _attached(rows: DataFrame, table: DataFrame, keys: list[str], total: int) -> DataFrame:
    """An inner join with a table of one row a key and the number ``c`` of its rows among ``total``.

    Keys of more than ``HOT_SHARE`` of the rows, at most a few times its reciprocal, are broadcast, so no task meets all rows of one.
    """
    often = F.col("c") > max(1, int(HOT_SHARE * total))
    hot, cold = F.broadcast(table.where(often).drop("c")), table.where(~often).drop("c")
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys))


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 4, den: int = 5, bucket: int | None = None, group: int = 256) -> DataFrame:
    """doc_id, n_shingles and component_id: the least id that links of Jaccard ``num / den`` or more reach.

    ``bucket``: classes up to which a prefix bucket is paired, ``BUCKET`` by default; ``group``: sets in one prefix tree.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // PREFIX_BYTES))
    # A word has about six bytes, so a counter holds some 20 to 40 shingles until the sketch has its full size.
    bits = min(max((chars // 256).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    described = materialize(docs.mapInArrow(trimmed(_describe(k, bits)), "doc_id long, n long, f1 long, f2 long, sketch binary"), "jaccard-sets")
    levels = spark.sparkContext.broadcast(_levels(described, bits, parts))
    packed = docs.mapInArrow(trimmed(_prefixes(k, num, den, parts, bits, levels)), "range int, heads binary, entries binary").repartition(parts, "range").sortWithinPartitions("range")
    raw = materialize(packed.mapInArrow(trimmed(_candidates(num, den, bucket or BUCKET)), _PAIRS), "jaccard-candidates")
    levels.unpersist()

    rows, same = described.where("sketch is null").select("doc_id", "n", "f1", "f2"), ["n", "f1", "f2"]
    some = rows.where("n > 0")
    classes = materialize(some.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")), "jaccard-reps")
    known = materialize(_attached(some, classes, same, rows.count()).select("doc_id", "n", "rep").unionByName(rows.where("n = 0").select("doc_id", "n", F.lit(None).cast("long").alias("rep"))), "jaccard-classes")
    to_rep = known.where("doc_id is not null and rep <> doc_id").select(F.col("doc_id").alias("copy"), "rep").distinct()

    def represented(df: DataFrame, column: str) -> DataFrame:
        return df.join(to_rep, df[column] == F.col("copy"), "left").withColumn(column, F.coalesce("rep", column)).drop("copy", "rep")

    def labelled(links: DataFrame) -> DataFrame:
        own = known.where("doc_id is not null and n > 0").select(F.col("rep").alias("src"), F.col("doc_id").alias("dst")).where("src <> dst")
        repeated = own.join(own.groupBy("dst").agg(F.countDistinct("src").alias("c")).where("c > 1"), "dst", "left_semi").select("src", "dst")
        return materialize(connected_components(links.unionByName(repeated)), "jaccard-labels")

    def of_reps(pairs: DataFrame) -> DataFrame:
        return represented(represented(pairs.select("a", "b"), "a"), "b")

    small = raw.where("token is null")
    links = _links(of_reps(small), docs, k, num, den, group)
    labels = labelled(links)

    members = represented(raw.where("token is not null").select("token", F.col("a").alias("member"), "n"), "member").withColumnRenamed("member", "rep").distinct()
    members = materialize(members, "jaccard-crowd")
    # The member of most large buckets stands in the middle of its group of copies: most others are linked with it, if with any.
    known_well = members.groupBy("rep").agg(F.count("*").alias("w"))
    anchors = members.join(known_well, "rep").groupBy("token").agg(F.max_by("rep", F.struct("w", -F.col("rep"))).alias("anchor"), F.count("*").alias("c"))
    anchors, crowd = materialize(anchors, "jaccard-anchors"), members.count()

    def mixed(labels: DataFrame) -> DataFrame:
        """(anchor, token, rep, n, label) of large buckets with more than one component."""
        rows = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("token", "rep", "n", F.coalesce("component", "rep").alias("label"))
        some = rows.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("token")
        return _attached(rows, anchors.join(some, "token", "left_semi"), ["token"], crowd)

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        """The labels after more links: components of labels, since what they hold is connected already."""
        side = lambda s: labels.select(F.col("node").alias(s), F.col("component").alias(f"{s}_label"))
        at = links.join(side("src"), "src", "left").join(side("dst"), "dst", "left")
        found = connected_components(at.select(F.coalesce("src_label", "src").alias("src"), F.coalesce("dst_label", "dst").alias("dst")))
        found = materialize(found.select(F.col("node").alias("of"), F.col("component").alias("whole")), "jaccard-joined")
        grown = labels.join(found, F.col("component") == F.col("of"), "left").select("node", F.coalesce("whole", "component").alias("component"))
        alone = found.join(labels, F.col("of") == F.col("node"), "left_anti").select(F.col("of").alias("node"), F.col("whole").alias("component"))
        return materialize(grown.unionByName(alone), "jaccard-labels")

    rest = materialize(mixed(labels).select("anchor", "rep", "n", "label").distinct(), "jaccard-mixed")
    middle = rest.where("rep = anchor").select("anchor", F.col("n").alias("m"), F.col("label").alias("own")).distinct()
    stars = rest.join(middle, "anchor").where((F.col("label") != F.col("own")) & (den * F.least("n", "m") >= num * F.greatest("n", "m"))).select(F.col("anchor").alias("a"), F.col("rep").alias("b"))
    if not stars.isEmpty():
        labels = joined(labels, _links(stars, docs, k, num, den, group))
        rest = materialize(mixed(labels).select("anchor", "rep", "n", "label").distinct(), "jaccard-mixed")
    if not rest.isEmpty():
        # Tiles of the members outside the largest component come first; a cell is one of these and any other tile.
        by_label = rest.groupBy("anchor", "label").agg(F.count("*").alias("c"))
        tiles = by_label.groupBy("anchor").agg(F.max_by("label", F.struct("c", -F.col("label"))).alias("most"), F.ceil((F.sum("c") - F.max("c")) / group).alias("few"), F.ceil(F.max("c") / group).alias("many"))
        sets = _sets_of(docs, rest.select(F.col("rep").alias("doc_id")).distinct(), k).withColumnRenamed("doc_id", "rep")
        minor = F.col("label") != F.col("most")
        tile = F.when(minor, F.pmod(F.xxhash64("rep"), F.col("few"))).otherwise(F.col("few") + F.pmod(F.xxhash64("rep"), F.col("many")))
        others = F.sequence(F.lit(0).cast("long"), F.when(minor, F.col("few") + F.col("many")).otherwise(F.col("few")) - 1)
        cells = rest.join(tiles, "anchor").withColumn("tile", tile).withColumn("u", F.explode(others))
        cells = cells.select("anchor", F.least("tile", "u").alias("i"), F.greatest("tile", "u").alias("j"), "rep", "n", "label", "tile").join(sets, "rep")
        links = cells.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j").mapInArrow(trimmed(_cells(num, den)), "src long, dst long")
        labels = joined(labels, materialize(links, "jaccard-links"))
    at = F.coalesce(F.col("rep"), F.col("doc_id"))
    out = known.withColumn("at", at).join(labels, F.col("at") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", F.when(F.col("doc_id").isNotNull(), F.col("at"))).alias("component_id"))
