import hashlib
import re
import time

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.functions import text as T
from lakeloom.operators import dedup, docs, explore, manifest
from lakeloom.operators.components import connected_components
from lakeloom.plans import queries
from lakeloom.sources.files import line_chunks


def chunked(spark, texts, size=20, overlap=5):
    df = spark.createDataFrame([(f"/d/{i}.txt", t) for i, t in enumerate(texts)], "source_path string, text string")
    return line_chunks(df, size=size, overlap=overlap)


def test_line_chunks_sizes(spark):
    def starts(n):
        return [r[0] for r in chunked(spark, ["\n".join(f"l{i}" for i in range(n))], 500, 50).orderBy("chunk_index").select("chunk_index").collect()]

    assert starts(1) == [0] and starts(460) == [0, 1] and starts(500) == [0, 1] and starts(450) == [0]
    blank = "\n".join(["a"] * 15 + [""] * 30 + ["b"] * 5)
    got = [(r["chunk_index"], r["filename"]) for r in chunked(spark, [blank]).orderBy("chunk_index").collect()]
    assert got == [(0, "/d/0.txt_0"), (2, "/d/0.txt_2"), (3, "/d/0.txt_3")]
    assert chunked(spark, [None, ""]).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 70), st.integers(2, 9), st.integers(0, 3))
def test_reassemble_is_the_inverse_for_different_lines(spark, n, size, overlap):
    text = "\n".join(f"line {i}" for i in range(n))
    got = docs.reassemble(chunked(spark, [text], size, min(overlap, size - 1))).collect()
    assert [(r["base_path"], r["text"]) for r in got] == [("/d/0.txt", text)]


def test_reassemble_drops_false_overlap_and_keeps_single_chunks(spark):
    rows = [("a.txt_0", "x\r\ny\n"), ("b.txt_0", "p\nq\nq"), ("b.txt_1", "q\nq\nr")]
    got = {r[0]: r[1] for r in docs.reassemble(spark.createDataFrame(rows, "filename string, text string")).collect()}
    assert got == {"a.txt": "x\r\ny\n", "b.txt": "p\nq\nq\nr"}


def make(spark, rows):
    return spark.createDataFrame(rows, "base_path string, text string")


def test_hash_groups(spark):
    x = make(spark, [("a", "T x"), ("b", "T x"), ("c", "t  X"), ("d", "u"), ("e", "U "), ("f", "w")])
    got = {(r["base_path"], r["hash_type"], r["first_path"]) for r in dedup.hash_groups(x).collect()}
    assert got == {("a", "exact", "a"), ("b", "exact", "a"), ("d", "normalized", "d"), ("e", "normalized", "d")}
    assert {r[0] for r in dedup.representatives(x, dedup.hash_groups(x)).select("base_path").collect()} == {"a", "c", "d", "f"}


def test_minhash_pairs(spark):
    words = [f"w{i}" for i in range(200)]
    near = words[:]
    near[100] = "other"
    x = make(spark, [("a", " ".join(words)), ("b", " ".join(near)), ("c", " ".join(f"z{i}" for i in range(200))), ("d", ""), ("e", "  "), ("f", " ".join(words))])
    got = {(r["path_a"], r["path_b"]): r["jaccard_est"] for r in dedup.band_pairs(dedup.minhash_signatures(x)).collect()}
    assert got[("a", "f")] == 1.0 and got[("d", "e")] == 1.0 and got[("a", "b")] > 0.85
    assert all("c" not in p for p in got)


def test_manifest(spark):
    x = make(spark, [(p, p) for p in ("long/a", "b", "c", "d", "e")])
    groups = spark.createDataFrame([("long/a", "exact", "h", "b"), ("b", "exact", "h", "b")], "base_path string, hash_type string, content_hash string, first_path string")
    pairs = spark.createDataFrame([("b", "c", 0.9)], "path_a string, path_b string, jaccard_est double")
    m = manifest.dedup_manifest(x, groups, pairs)
    got = {r["base_path"]: (r["cluster"], r["is_representative"], r["duplicate_of"], r["source"]) for r in m.collect()}
    assert got == {"long/a": ("b", False, "b", "hash"), "b": ("b", True, None, "hash"), "c": ("b", False, "b", "lsh"), "d": ("d", True, None, None), "e": ("e", True, None, None)}
    assert manifest.dedup_summary(m).first().asDict() == {"total_docs": 5, "n_clusters": 3, "keep": 3, "drop": 2, "reduction_pct": 40.0}
    assert manifest.dedup_summary(m.limit(0)).first()["reduction_pct"] is None
    assert {tuple(r) for r in manifest.with_cluster_ids(m).select("base_path", "cluster_id").collect()} == {("long/a", 0), ("b", 0), ("c", 0), ("d", 1), ("e", 2)}


def test_pair_histogram_edges(spark):
    d = spark.createDataFrame([(str(n), n) for n in (1, 2, 5, 6, 20, 21, 100, 101, 500, 501)], "base_path string, pair_count long")
    got = {r["bucket"]: (r["n_docs"], r["min_pairs"], r["max_pairs"]) for r in dedup.pair_histogram(d).collect()}
    assert got == {"1": (1, 1, 1), "2-5": (2, 2, 5), "6-20": (2, 6, 20), "21-100": (2, 21, 100), "101-500": (2, 101, 500), "500+": (1, 501, 501)}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components(spark, links):
    parent = list(range(26))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {i: root(i) for i in {x for p in links for x in p}}


def test_folders(spark):
    c = spark.createDataFrame([("I:\\a\\b\\f.pdf_0", 3), ("I:\\a\\b\\f.pdf_1", None), ("I:\\a\\b\\g\\h.pdf_0", 5), ("a/b/g", 7)], "filename string, token_count long")
    stats = explore.file_stats(c)
    assert {tuple(r) for r in stats.collect()} == {("a/b/f.pdf", 2, 3), ("a/b/g/h.pdf", 1, 5), ("a/b/g", 1, 7)}
    assert explore.auto_skip(stats) == ["a", "b"]
    assert {tuple(r) for r in explore.children(stats, ["a", "b"]).collect()} == {("f.pdf", False, 1, 2, 3), ("g", True, 2, 2, 12)}
    assert explore.children(stats.where(F.lit(False)), []).count() == 0


def test_band_links_join_what_band_pairs_join(spark):
    """One band that many documents share: as many rows as documents, the same components."""
    base = [7] * dedup.ROWS
    rows = [(f"d{i:02}", base + [1000 * i + j for j in range(dedup.SLOTS - dedup.ROWS)]) for i in range(40)] + [("x1", list(range(5000, 5128))), ("x2", list(range(5000, 5128))), ("y", list(range(9000, 9128)))]
    signatures = spark.createDataFrame(rows, "base_path string, signature array<long>")
    pairs, links = dedup.band_pairs(signatures), dedup.band_links(signatures)
    assert pairs.count() == 40 * 39 // 2 + 1 and links.count() == 39 + 1
    sides = lambda df: {x for r in df.collect() for x in (r["path_a"], r["path_b"])}
    assert sides(pairs) == sides(links)


def test_embed_duplicates(spark):
    docs = spark.createDataFrame([("a", "x x y"), ("b", "x x y y"), ("c", "z"), ("d", None), ("e", "x x y")], "base_path string, text string")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "d"), ("a", "e"), ("a", "gone")], "path_a string, path_b string")
    model = lambda texts: [[float(t.count(c)) for c in "xyz"] for t in texts]
    got = {r["path_b"]: round(r["cosine_sim"], 4) for r in dedup.embed_duplicates(docs, pairs, model).collect()}
    assert got == {"b": round(6 / (5 * 8) ** 0.5, 4), "e": 1.0}


def test_numbers_do_not_depend_on_the_width_of_rows(spark):
    """Wide rows and narrow sizes coalesce differently: both must see one set of partitions."""
    wide = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.sha2(F.concat_ws("-", "id", i).cast("binary"), 256)), "")
    x = spark.range(3000).withColumn("wide", wide)
    got = dedup._numbered(x, ["id"], "n").select("id", "n", F.length("wide").alias("w")).collect()
    assert sorted((r["id"], r["n"], r["w"]) for r in got) == [(i, i, 3840) for i in range(3000)]


def test_group_ids_are_whole_and_gapless(spark):
    """Long paths in many groups: no member is lost and the ids are those of a dense rank."""
    stem = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.sha2(F.concat_ws("-", F.col("id") % 1500, i).cast("binary"), 256)), "")
    g = spark.range(3000).select(F.concat(F.format_string("%06d", F.col("id")), stem).alias("base_path"), F.lit("exact").alias("hash_type"), F.sha2((F.col("id") % 1500).cast("string").cast("binary"), 256).alias("content_hash"), F.concat(F.format_string("%06d", F.col("id") % 1500), stem).alias("first_path"))
    got = sorted((r[0][:6], r[1]) for r in dedup.group_ids(g).select("base_path", "group_id").collect())
    assert got == [(f"{i:06d}", i % 1500) for i in range(3000)]


def _plan(df):
    return df._jdf.queryExecution().toString().lower()


def test_texts_are_hashed_once_and_bands_leave_signatures_behind(spark):
    x = make(spark, [("a", "T x"), ("b", "T x"), ("c", "t  X"), ("n", None), ("m", None)])
    groups = dedup.hash_groups(x)
    assert "sha2(" not in _plan(groups) and "regexp" not in _plan(groups)
    assert {r[0] for r in groups.collect()} == {"a", "b"}
    s = dedup.minhash_signatures(x)
    assert "md5(" not in _plan(s) and "signature" not in _plan(dedup.band_links(s))


def test_signatures_follow_the_formula_on_odd_texts(spark):
    """The JVM's white space and lower case, words of any bytes, fewer than five words, repeats."""
    texts = ["A b C d\x1ce f\x1d g", "İ ÄÖ 漢字 x y z", "one two", "", " \t\n", "x " * 700, "\u0085a b c　d e\x0bf"]
    x = make(spark, [(str(i), t) for i, t in enumerate(texts)])
    got = {r[0]: r[1] for r in dedup.minhash_signatures(x).collect()}
    grams = {r[0]: r[1] or [""] for r in x.select("base_path", T.shingles(F.col("text"))).collect()}
    for path, g in grams.items():
        h = [int(hashlib.md5(y.encode()).hexdigest()[:8], 16) % dedup.PRIME for y in g]
        assert got[path] == [min((a * y + b) % dedup.PRIME for y in h) for a, b in dedup.slot_constants()]
    want = {r[0]: hashlib.sha256(r[1].encode()).hexdigest() for r in x.select("base_path", T.normalize_text(F.col("text"))).collect()}
    twice = x.unionByName(x.select(F.concat("base_path", F.lit("-")).alias("base_path"), F.concat(F.lit("\n"), F.upper(F.lower("text")), F.lit("  ")).alias("text")).where("base_path <> '1-'"))
    for r in dedup.normalized_groups(twice).collect():
        assert r["content_hash"] == want[r["base_path"].rstrip("-")]


def _plain_slots(h):
    """The formula in 64-bit integers."""
    a, b = (np.array(x, np.uint64)[:, None] for x in zip(*dedup.slot_constants(), strict=True))
    low = np.full(dedup.SLOTS, dedup.PRIME, np.uint32)
    for i in range(0, len(h), 512):
        x = a * h[None, i : i + 512].astype(np.uint64)
        x += b
        high = x >> np.uint64(31)
        x &= np.uint64(dedup.PRIME)
        x += high
        y = x.astype(np.uint32)
        np.minimum(low, np.minimum(y, y - np.uint32(dedup.PRIME)).min(axis=1), out=low)
    return low.astype(np.int64)


def test_slots_are_exact_at_the_ends_of_their_range():
    """Hashes at which some function is 0, 1 or the largest remainder, and the least and largest hashes."""
    p = dedup.PRIME
    ends = [(v - b) * pow(a, -1, p) % p for a, b in dedup.slot_constants() for v in (0, 1, p - 2, p - 1)]
    for h in [*ends, 0, 1, 65535, 65536, p - 1]:
        assert dedup._slots(np.array([h])).tolist() == [(a * h + b) % p for a, b in dedup.slot_constants()]


def test_slots_take_less_than_integer_arithmetic():
    h = np.random.default_rng(5).integers(0, dedup.PRIME, 100_000).astype(np.uint64)
    assert dedup._slots(h).tolist() == _plain_slots(h).tolist()
    took = {dedup._slots: [], _plain_slots: []}
    for f in [*took] * 3:
        began = time.perf_counter()
        f(h)
        took[f].append(time.perf_counter() - began)
    assert min(took[dedup._slots]) < 0.7 * min(took[_plain_slots])


def test_shingles_of_many_texts_are_hashed_together():
    """Strings of every length about a block of MD5, texts of few words and none, in less time than one by one."""
    line = bytes(np.random.default_rng(3).integers(33, 127, 4000).astype(np.uint8))
    start, size = np.arange(3000), np.arange(3000) % 130
    assert dedup._many_md5(line, start, size).tolist() == [int(hashlib.md5(line[s : s + n]).hexdigest()[:8], 16) for s, n in zip(start.tolist(), size.tolist(), strict=True)]
    texts = ["a b c d e f", "", "one two", "é" * 30 + " b c d e", "x " * 9, "last"]
    words = [t.split() for t in texts]
    grams = [[" ".join(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else w or [""] for w in words]
    plain = lambda g: [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in g]
    assert [h.tolist() for h in dedup._hashes(texts)] == [plain(g) for g in grams]
    assert dedup._hashes([]) == [] and [len(x) for x in dedup._blocks(["a" * dedup._BLOCK, "b", "c"])] == [1, 2]
    many = [" ".join(f"w{i * j}" for j in range(500)) for i in range(200)]
    runs = [(t.encode(), [m.start() + 1 for m in re.finditer(" ", t)]) for t in many]
    together = lambda: dedup._hashes(many)
    single = lambda: [[hashlib.md5(b[s:e]).digest()[:4] for s, e in zip([0, *c], [x - 1 for x in c[4:]] + [len(b)], strict=False)] for b, c in runs]
    took = {}
    for f in (together, single) * 3:
        began = time.perf_counter()
        f()
        took[f] = min(took.get(f, 9e9), time.perf_counter() - began)
    assert took[together] < took[single]


def test_texts_and_signatures_stay_where_they_are(spark, monkeypatch):
    """Paths are broadcast to them up to a count, whatever Spark takes for small; beyond, the results are the same."""
    x = make(spark, [("a", "t x y z w v"), ("b", "t x y z w v"), ("c", "t x y z w v u"), ("d", "other")])
    groups, pairs = dedup.hash_groups(x), dedup.band_links(dedup.minhash_signatures(x))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept, some = dedup.representatives(x, groups), dedup.candidate_docs(x, pairs)
        assert all("broadcasthashjoin" in _plan(y) and "sortmergejoin" not in _plan(y) for y in (kept, some))
        monkeypatch.setattr(dedup, "FEW", 0)
        far_kept, far_some = dedup.representatives(x, groups), dedup.candidate_docs(x, pairs)
        assert "sortmergejoin" in _plan(far_kept)
        assert sorted(far_kept.collect()) == sorted(kept.collect()) and sorted(far_some.collect()) == sorted(some.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r[0] for r in kept.collect()} == {"a", "c", "d"}


def test_queries_on_pairs_read_the_texts_once(spark, monkeypatch):
    """hashes and signatures come from one reading, and are those that the separate operators make."""
    x = make(spark, [("a", "T x y z w v"), ("b", "t  X y z w v"), ("c", "T x y z w v"), ("d", "é y\u3000z w v u"), ("e", None), ("f", ""), ("g", "t x")])
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(queries.A, "docs", lambda s, d: x.repartition(2).mapInArrow(counted, "base_path string, text string"))
    assert {tuple(r) for r in queries.QUERIES["min_jaccard"](spark, "").collect()} == {("a", "b", 1.0), ("e", "f", 1.0)}
    assert read.value == 7
    both = dedup.signed(x)
    plain = {r[0]: r[1] for r in dedup.minhash_signatures(x).collect()}
    assert {r["base_path"]: r["signature"] for r in both.collect()} == plain
    assert sorted(dedup.hash_groups(both).collect()) == sorted(dedup.hash_groups(x).collect())


def test_pairs_of_a_crowded_bucket_meet_once_in_blocks(spark, monkeypatch):
    """documents that share one band, some or all, in buckets of one block and of several: each pair once, with its estimate."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 9_000, dedup.SLOTS)
    rows = []
    for i in range(60):
        own = np.where(np.arange(dedup.SLOTS) // dedup.ROWS % 6 < i % 6, base, rng.integers(10_000, 2**31 - 1, dedup.SLOTS))
        rows.append((f"d{i * 7 % 60:02}", own.tolist()))
    rows += [("same", rows[5][1]), ("again", rows[5][1])]
    parts = [(p, np.array(v)) for p, v in sorted(rows)]
    want = {}
    for i, (p, v) in enumerate(parts):
        for q, w in parts[i + 1 :]:
            if (v == w)[: dedup.BANDS * dedup.ROWS].reshape(-1, dedup.ROWS).all(axis=1).any() and "same" not in (p, q) and rows[5][0] not in (p, q):
                want[p, q] = (v == w).mean()
    want |= {("again", "same"): 1.0, ("again", rows[5][0]): 1.0}
    signatures = spark.createDataFrame(rows, "base_path string, signature array<long>")
    for crowd in (2000, 7):
        monkeypatch.setattr(dedup, "CROWD", crowd)
        for least in (0.0, 0.5):
            got = [tuple(r) for r in dedup.band_pairs(signatures, least).collect()]
            assert len(got) == len({g[:2] for g in got})
            assert {(a, b): e for a, b, e in got} == {k: e for k, e in want.items() if e >= least}
        degrees = {tuple(r) for r in dedup.band_degrees(signatures).collect()}
        assert degrees == {(p, sum(p in k for k in want)) for p in {x for k in want for x in k}}


def _made(spark, monkeypatch, name):
    """Tables that a query on a few documents writes, and its rows."""
    x = make(spark, [(p, f"{p} t x y z w v") for p in "abcde"] + [(p, " ".join(f"w{i}" for i in range(99)) + p) for p in ("m", "n", "o")])
    tags, rows = [], queries.QUERIES[name]
    write = dedup.materialize
    monkeypatch.setattr(queries.A, "docs", lambda s, d: x)
    for module in (dedup, queries):
        monkeypatch.setattr(module, "materialize", lambda df, tag: (tags.append(tag), write(df, tag))[1])
    return [tuple(r) for r in rows(spark, "").collect()], tags


def test_top_by_pairs_counts_without_making_pairs(spark, monkeypatch):
    """F16: a bucket gives each document's number of pairs, so nothing written grows with the pairs."""
    rows, tags = _made(spark, monkeypatch, "top_by_pairs")
    assert rows == [("m", 2), ("n", 2), ("o", 2)]
    assert "band-pairs" not in tags and "met" not in tags


def test_pair_histogram_counts_without_making_pairs(spark, monkeypatch):
    """the same for the histogram and for the degrees themselves."""
    rows, tags = _made(spark, monkeypatch, "pair_histogram")
    assert rows == [("2-5", 3, 2, 2)]
    degrees, more = _made(spark, monkeypatch, "pair_degree")
    assert sorted(degrees) == [("m", 2), ("n", 2), ("o", 2)]
    assert "band-pairs" not in tags + more and "met" not in tags + more
