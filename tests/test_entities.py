import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import extract, graph, resolve
from lakeloom.plans.storage import materialize
from lakeloom.sources import files

ENTITY = "entity_id long, name string, type string, description string, first_seen_document string, documents_appeared array<string>"
REL = "relationship_id long, source string, target string, type string, description string, document_id string"


def entities(spark, rows):
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], ENTITY)


def test_merge_by_key(spark):
    e = entities(
        spark,
        [
            ("Mr. John Doe", "person", "Inspector one", "d1", ["d1", "d2"]), ("John Doe", "person", "Site inspector", "d2", ["d2", "d10", "d9"]), ("john doe", "org", None, "d3", None),
            ("ACME Corp", "organization", "", "d1", ["d1"]), ("ACME Corp, Inc.", "organization", "x", "d1", ["d1"]), ("Jane Smith", "person", "z", "d1", ["d2", "d1"]),
        ],
    )
    g = resolve.merge_groups(e)
    assert {(r["name"], r["canonical"]) for r in g.collect()} == {("Mr. John Doe", "John Doe"), ("John Doe", "John Doe"), ("john doe", "John Doe"), ("ACME Corp", "ACME Corp, Inc."), ("ACME Corp, Inc.", "ACME Corp, Inc.")}
    m = {r["name"]: r for r in resolve.merged_entities(e, g).collect()}
    assert sorted(m) == ["ACME Corp, Inc.", "Jane Smith", "John Doe"]
    assert m["John Doe"]["documents_appeared"] == ["d1", "d10", "d2", "d9"] and m["John Doe"]["description"] == "Site inspector" and m["John Doe"]["entity_id"] == 7
    assert m["Jane Smith"]["documents_appeared"] == ["d2", "d1"] and m["ACME Corp, Inc."]["entity_id"] == 8
    names = resolve.name_map(g)
    r = spark.createDataFrame([(1, "Mr. John Doe", "ACME Corp", "t", "a", "d"), (2, "John Doe", "ACME Corp, Inc.", "t", "b", "d"), (3, None, "q", "t", "b", "d")], REL)
    mapped = resolve.map_names(r, names, ["source", "target"])
    assert {(x["relationship_id"], x["n_changed"]) for x in mapped.collect()} == {(1, 2), (2, 0), (3, 0)}
    assert {x["relationship_id"] for x in resolve.dedup_relationships(mapped).collect()} == {1, 3}


FUZZY = ["Smith, William", "William Smith", "Michael A. Johnson", "Michael Johnson", "John Doe", "Jon Doe", "Baytown Const", "Baytown Construction", "James Wilson", "James Williams", "Jane Williams", "R. Smith", "Robert Smith"]


def test_fuzzy_clusters(spark):
    e = entities(spark, [(n, "person", "", "d", ["d1", "d2"] if n in ("Jane Williams", "Michael Johnson", "John Doe", "William Smith") else ["d1"]) for n in FUZZY])
    p = resolve.scored_pairs(e, 0.88)
    assert p.count() == 6
    g = resolve.cluster_pairs(e, p)
    final = {r["name"] for r in resolve.merged_entities(e, g).collect()}
    assert final == {"Baytown Construction", "Jane Williams", "John Doe", "Michael Johnson", "Robert Smith", "R. Smith", "William Smith"}
    assert g.select("group_key").distinct().count() == 5


def test_topk_is_asymmetric_and_exact(spark, monkeypatch):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.astype("float32").tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>").repartition(5)
    monkeypatch.setattr(resolve, "BLOCK_ROWS", 25)
    got = {(r["i"], r["j"]) for r in resolve.topk_neighbours(df, 4).collect()}
    sims = v.astype("float32").astype(float) @ v.astype("float32").astype(float).T
    np.fill_diagonal(sims, -9)
    assert got == {(i, int(j)) for i in range(60) for j in np.argsort(-sims[i], kind="stable")[:4]}
    pairs = {(r["i"], r["j"]) for r in resolve.neighbour_pairs(df, 0.3, 4).collect()}
    assert pairs == {(i, j) for i, j in got if j > i and sims[i, j] >= 0.3}


def test_extraction(spark):
    good = '```json\n{"metadata":{"sender":["a","","b"],"subject":null},"entities":[{"name":" X ","type":"p","description":"one"},{"name":"X","type":"p","description":"two"},{"name":"","type":"p"},{"name":"  ","type":"q"}],"relationships":[{"source":"X","target":"Y","type":"t"}]}\n```'
    df = spark.createDataFrame([(2, good), (1, "no json"), (3, '{"metadata":null}')], "chunk_id long, reply string")
    p = extract.parse_replies(df)
    assert {(r["document_id"], r["sender"], r["subject"]) for r in extract.documents(p).collect()} == {("2", "a, b", ""), ("1", "", ""), ("3", "", "")}
    e = {(r["name"], r["type"]): (r["description"], r["first_seen_document"], r["documents_appeared"]) for r in extract.fold_entities(extract.mentions(p)).collect()}
    assert e == {("X", "p"): ("one", "2", ["2"]), ("", "q"): ("", "2", ["2"])}
    assert [tuple(r) for r in extract.relationships(p).drop("nth").collect()] == [("X", "Y", "t", "", "2")]
    log = extract.processing_log(p)
    assert {(r["document_id"], r["success"], r["readable"]) for r in log.collect()} == {("1", True, False), ("2", True, True), ("3", True, False)}
    assert extract.resume_docs(df, log.where("document_id <> '1'")).count() == 1


def test_graph(spark, tmp_path):
    e = entities(spark, [("A", "p", "d1", "1", ["1", "2", "9"]), ("B", "q", None, "2", ["2"]), ("A", "r", "d2", "1", ["3"]), ("Z", "q", "", None, None)])
    files = graph.chunk_files(spark.createDataFrame([(1, "x/f.pdf_0"), (2, "x/f.pdf_4"), (3, "y/g.pdf_1")], "chunk_id long, filename string"))
    n = {r["name"]: r for r in graph.nodes(e, files).collect()}
    assert [tuple(x) for x in n["A"]["documents"]] == [("x/f.pdf", "1"), ("9", "?"), ("y/g.pdf", "2")] and n["A"]["entity_type"] == "p"
    assert n["Z"]["document_count"] == 0 and n["Z"]["first_seen_display"] == "unknown" and n["B"]["first_seen_display"] == "f.pdf"
    rows = [(i, "A", "B", "t", str(i), "d") for i in range(4)] + [(i, "B", "A", "u", None, None) for i in range(4, 6)] + [(9, "A", "A", "s", "", "d"), (10, "A", "gone", "s", "", "d"), (11, "", "A", "s", "", "d")]
    edges = graph.edges(spark.createDataFrame(rows, REL), graph.nodes(e, files).select("name"))
    got = {(r["source"], r["target"]): (r["weight"], len(r["relationships"])) for r in edges.collect()}
    assert got == {("A", "B"): (6, 5), ("A", "A"): (1, 1)}
    d = {r["name"]: r["connections"] for r in graph.with_degrees(graph.nodes(e, files), edges).collect()}
    assert d == {"A": 8, "B": 6, "Z": 0}
    graph.export_json(graph.with_degrees(graph.nodes(e, files), edges), edges, str(tmp_path / "g.json"))
    whole = json.loads((tmp_path / "g.json").read_text())
    assert whole["stats"]["node_count"] == 3 == len(whole["nodes"]) and len(whole["links"]) == 2 and whole["stats"]["type_counts"]["p"] >= 1
    graph.export_tables(graph.nodes(e, files), edges, str(tmp_path / "g"))
    assert spark.read.json(str(tmp_path / "g" / "links")).count() == 2 and spark.read.json(str(tmp_path / "g" / "nodes")).count() == 3


def modularity(links, of):
    total = sum(w for _, _, w in links)
    strength, inside = {}, 0.0
    for a, b, w in links:
        strength[of[a]] = strength.get(of[a], 0) + w
        strength[of[b]] = strength.get(of[b], 0) + w
        inside += w * (of[a] == of[b])
    return inside / total - sum((s / 2 / total) ** 2 for s in strength.values())


def merged_by_hand(links, names):
    """The rounds of merges with dictionaries; (community of each name, modularity after each round)."""
    strength, total = {n: 0.0 for n in names}, sum(2.0 * w for _, _, w in links)
    for a, b, w in links:
        strength[a] += w
        strength[b] += w
    of, turn, seen = {n: n for n in names}, 0, []
    while True:
        between, s = {}, {}
        for n in names:
            s[of[n]] = s.get(of[n], 0) + strength[n]
        for a, b, w in links:
            if of[a] != of[b]:
                for x, y in ((of[a], of[b]), (of[b], of[a])):
                    between[x, y] = between.get((x, y), 0) + w
        gain = {(x, y): w * total - s[x] * s[y] for (x, y), w in between.items()}
        if not any(g > 0 for g in gain.values()):
            return of, seen
        waits = {c: hashlib.md5(f"{turn}:{c}".encode()).hexdigest()[0] < "8" for c in s}
        best = {}
        for (x, y), g in gain.items():
            if g > 0 and not waits[x] and waits[y]:
                best[x] = max(best.get(x, (g, y)), (g, y))
        into = {}
        for head in {y for _, y in best.values()}:
            tails = [x for x, (_, y) in best.items() if y == head]
            others = sum(s[x] for x in tails)
            fits = [x for x in tails if best[x][0] > s[x] * (others - s[x]) / 2]
            into |= {x: head for x in [*fits, max(tails, key=lambda x: (best[x][0] / s[x] + s[x] / 2, x))]}
        of = {n: into.get(c, c) for n, c in of.items()}
        turn += 1
        seen.append(modularity(links, of))


def numbered(of):
    groups = {}
    for n, c in of.items():
        groups.setdefault(c, []).append(n)
    return {n: k for k, g in enumerate(sorted(groups.values(), key=lambda g: (-len(g), min(g)))) for n in g}


def found_communities(spark, links, names):
    edges = spark.createDataFrame([(a, b, int(w)) for a, b, w in links], "source string, target string, weight long")
    nodes = spark.createDataFrame([(n,) for n in names], "name string")
    found = graph.communities(nodes, edges)
    got = {r["name"]: r["community"] for r in found.collect()}
    if links:
        assert graph.modularity(edges, found).first()["modularity"] == pytest.approx(modularity(links, got))
    return got


def test_communities_of_cliques(spark):
    links = [(f"{c}{i}", f"{c}{j}", 1) for c in "abc" for i in range(5) for j in range(i)] + [("a0", "b0", 1), ("b1", "c0", 1)]
    names = sorted({x for a, b, _ in links for x in (a, b)} | {"alone"})
    got = found_communities(spark, links, names)
    found = spark.createDataFrame([(n, k, len(n)) for n, k in got.items()], "name string, community int, connections long")
    top = graph.top_communities(graph.community_summary(found.select("name", "connections"), found.select("name", "community")), 2).collect()
    assert [(r["community"], r["size"]) for r in top] == [(0, 5), (1, 5)]
    assert len(set(got.values())) == 4 and all(got[f"{c}{i}"] == got[f"{c}0"] for c in "abc" for i in range(5))
    assert found_communities(spark, [], ["x", "y"]) == {"x": 0, "y": 1}


def test_communities_against_plain_rounds(spark):
    """Planted groups, a hub, loops: the same labels as by hand, a modularity that only rises and is near the planted one."""
    rng = random.Random(1)
    names = [f"n{i:02}" for i in range(60)]
    links = [(a, b, rng.randint(1, 3)) for i, a in enumerate(names) for b in names[:i] if rng.random() < (0.5 if int(a[1:]) % 4 == int(b[1:]) % 4 else 0.03)]
    links += [("n00", n, 1) for n in names[1::7] if ("n00", n) not in {(a, b) for a, b, _ in links} and (n, "n00") not in {(a, b) for a, b, _ in links}] + [("n05", "n05", 2)]
    got = found_communities(spark, links, names)
    want, rises = merged_by_hand(links, names)
    assert got == numbered(want) and rises == sorted(rises)
    planted = modularity(links, {n: int(n[1:]) % 4 for n in names})
    assert rises[-1] > 0.8 * planted


def test_communities_of_a_star(spark):
    """A hub with many leaves ends after a few rounds."""
    links = [("hub", f"leaf{i}", 1) for i in range(200)]
    names = ["hub"] + [f"leaf{i}" for i in range(200)]
    assert found_communities(spark, links, names) == numbered(merged_by_hand(links, names)[0])


def test_frequent_token_is_split(spark, monkeypatch):
    """A token that all names share: all pairs once, dealt over many tasks, none by one key."""
    monkeypatch.setattr(resolve, "TOKEN_ROWS", 8)
    names = [f"shared thing{i % 30} part{i}" for i in range(60)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    pairs = resolve.token_pairs(df)
    got = [(r["name_a"], r["name_b"]) for r in pairs.collect()]
    assert len(got) == len(set(got)) == 60 * 59 // 2 and all(a < b for a, b in got)


def test_neighbours_of_equal_vectors(spark, monkeypatch):
    """Blocks of few rows give what one block gives; ties go to the lesser id."""
    monkeypatch.setattr(resolve, "BLOCK_ROWS", 7)
    rng = random.Random(3)
    vectors = [[1.0, 0.0, 0.0]] * 20 + [[rng.uniform(-1, 1) for _ in range(3)] for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in resolve.topk_neighbours(df, 4).collect():
        got.setdefault(r["i"], {})[r["rank"]] = (r["j"], r["sim"])
    for i, v in enumerate(vectors):
        sims = sorted((-round(sum(x * y for x, y in zip(v, w, strict=True)), 9), j) for j, w in enumerate(vectors) if j != i)[:4]
        assert [(-round(s, 9), j) for _, (j, s) in sorted(got[i].items())] == sims
    assert resolve.topk_neighbours(df.limit(0), 4).count() == 0


def test_failing_model_leaves_a_log_row(spark):
    def model(texts):
        if any("bad" in t for t in texts):
            raise ValueError("cannot read it")
        return ['{"entities":[{"name":"a","type":"t"}]}'] * len(texts)

    chunks = spark.createDataFrame([(i, "bad" if i % 4 == 0 else "good") for i in range(12)], "chunk_id long, text string").coalesce(1)
    parsed = extract.parse_replies(extract.ask(chunks, model))
    log = {r["document_id"]: (r["success"], r["error_message"]) for r in extract.processing_log(parsed).collect()}
    assert log == {str(i): (False, "ValueError: cannot read it") if i % 4 == 0 else (True, None) for i in range(12)}
    assert extract.mentions(parsed).count() == extract.documents(parsed).count() == 9
    assert {r["chunk_id"] for r in extract.resume_docs(chunks, extract.processing_log(parsed)).collect()} == {0, 4, 8}
    with pytest.raises(Exception, match="cannot read it"):
        files.map_texts(chunks, "text", "reply", model, "string").collect()


def _wide_entities(spark, n, docs):
    """``2 n`` entities, two of each key, each with many documents of its own."""
    seen = F.transform(F.sequence(F.lit(1), F.lit(docs)), lambda i: F.substring(F.sha2(F.concat_ws("-", "id", i).cast("binary"), 256), 1, 24))
    name = F.concat(F.when(F.col("id") < n, "Mr. ").otherwise(""), F.lit("alpha "), F.translate((F.col("id") % n).cast("string"), "0123456789", "qwertyuiop"))
    return spark.range(2 * n).select((F.col("id") + 1).alias("entity_id"), name.alias("name"), F.lit("person").alias("type"), F.lit(None).cast("string").alias("description"), F.lit("d").alias("first_seen_document"), seen.alias("documents_appeared"))


def test_merged_entities_keep_every_group_of_many_documents(spark):
    e = _wide_entities(spark, 1000, 150)
    got = sorted((r["entity_id"], r["n"]) for r in resolve.merged_entities(e, resolve.merge_groups(e)).select("entity_id", F.size("documents_appeared").alias("n")).collect())
    assert got == [(2000 + i + 1, 300) for i in range(1000)]


def test_cluster_pairs_of_merged_entities_with_many_documents(spark):
    e = _wide_entities(spark, 1000, 150)
    m = materialize(resolve.merged_entities(e, resolve.merge_groups(e)), "merged")
    first = m.agg(F.min("name")).first()[0]
    pairs = m.where(F.col("name") > first).select(F.lit(first).alias("name_a"), F.col("name").alias("name_b"))
    assert resolve.cluster_pairs(m, pairs).agg(F.countDistinct("name")).first()[0] == 1000


def test_topk_keeps_its_best_in_the_task_and_takes_copies_exactly(spark, monkeypatch):
    """Copies, zero vectors and differences below single precision; no second ranking of what each pair of blocks gave."""
    monkeypatch.setattr(resolve, "BLOCK_ROWS", 40)
    monkeypatch.setattr(resolve, "ASK_ROWS", 7)
    monkeypatch.setattr(resolve, "GIVE_ROWS", 16)
    rng = np.random.default_rng(3)
    v = rng.integers(-3, 4, (150, 4)).astype(float)
    v[20:60], v[60:70], v[70:80] = v[3], 0, v[4] + np.arange(10)[:, None] * 1e-12
    ids = rng.permutation(150) * 3
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<double>").repartition(5)
    out = resolve.topk_neighbours(df, 6)
    assert "Window" not in out._jdf.queryExecution().toString()
    want = set()
    for n, i in enumerate(ids):
        sims = (v[n] * v).sum(axis=1)
        order = [m for m in np.lexsort((ids, -sims)) if m != n][:6]
        want |= {(int(i), int(ids[m]), float(sims[m]), r + 1) for r, m in enumerate(order)}
    assert {tuple(r) for r in out.collect()} == want


def test_neighbour_pairs_of_many_copies(spark, monkeypatch):
    """Copies over several blocks: each row's neighbours are the least other ids, found without a second ranking."""
    monkeypatch.setattr(resolve, "BLOCK_ROWS", 10)
    df = spark.createDataFrame([(i, [1.0, 0.0] if i % 10 else [0.0, 1.0]) for i in range(120)], "vec_id long, embedding array<double>")
    out = resolve.neighbour_pairs(df, 0.9, 3)
    assert "Window" not in out._jdf.queryExecution().toString()
    want = set()
    for i in range(120):
        same = [j for j in range(120) if j != i and (j % 10 == 0) == (i % 10 == 0)][:3]
        want |= {(i, j, 1.0) for j in same if j > i}
    assert {tuple(r) for r in out.collect()} == want


def test_parts_of_the_graph_without_its_lists(spark):
    """Weights and attributes agree with edges and nodes and need no ranking or lists; rewritten rows without extras no sort."""
    e = entities(spark, [("A", "x", "d", "1", ["1", "2"]), ("A", "y", None, "2", ["2", "3", "4"]), ("B", None, "", "9", None), ("C", "z", "q", "4", ["4"])])
    files = spark.createDataFrame([("1", "f", "1"), ("2", "g", "1"), ("3", "g", "2"), ("4", "g", "3")], "chunk_id string, filename string, page string")
    some = graph.node_attributes(e, files)
    assert {tuple(r) for r in some.collect()} == {tuple(r) for r in graph.nodes(e, files).select("name", "entity_type", "description").collect()}
    assert {tuple(r) for r in some.collect()} == {("A", "x", "d"), ("B", "unknown", ""), ("C", "z", "q")}
    r = spark.createDataFrame([(1, "A", "B", "t", "d", "1"), (2, "B", "A", "t", "d", "2"), (3, "A", "A", "t", "d", "3"), (4, "A", "gone", "t", "d", "4"), (5, "A", "", "t", "d", "5"), (6, None, "B", "t", "d", "6")], REL)
    w = graph.weights(r, e.select("name").distinct())
    assert {tuple(x) for x in w.collect()} == {tuple(x) for x in graph.edges(r, e.select("name").distinct()).select("source", "target", "weight").collect()} == {("A", "B", 2), ("A", "A", 1)}
    few = spark.createDataFrame([(3, "A", "B", "t", "1"), (2, "A", "B", "t", "1"), (5, "A", None, "t", "1"), (None, "A", None, "t", "1")], "relationship_id long, source string, target string, type string, document_id string")
    once = resolve.dedup_relationships(few)
    assert {tuple(x) for x in once.collect()} == {(2, "A", "B", "t", "1"), (None, "A", None, "t", "1")}
    assert all("Window" not in x._jdf.queryExecution().toString() for x in (w, once, some))


def test_neighbour_pairs_score_again_only_what_reaches_the_threshold(spark, monkeypatch):
    """Rows below the threshold are no candidates, not even while a row knows fewer than k; the pairs are those of all neighbours."""
    rng = np.random.default_rng(11)
    v = rng.normal(size=(203, 16))
    v[50:60] = v[3] + rng.normal(size=(10, 16)) * 0.2
    v /= np.linalg.norm(v, axis=1)[:, None]
    sims = (v[:, None] * v[None]).sum(axis=2)
    ids = np.arange(203)
    taken = []
    take = resolve._Best._take
    monkeypatch.setattr(resolve._Best, "_take", lambda self, row, ids, s: (taken.extend(s), take(self, row, ids, s)))
    best = resolve._Best(5, ids, v, 0.6)
    for at in range(0, 203, 40):
        best.meet(ids[at : at + 40], v[at : at + 40])
    assert 90 <= len(taken) <= (sims >= 0.6 - 1e-4).sum() - 203 and min(taken) > 0.6 - 1e-4
    monkeypatch.setattr(resolve._Best, "_take", take)
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<double>")
    want = {(int(i), int(j), round(float(sims[i, j]), 4)) for i in ids for j in [m for m in np.lexsort((ids, -sims[i])) if m != i][:5] if j > i and sims[i, j] >= 0.6}
    assert {tuple(r) for r in resolve.neighbour_pairs(df, 0.6, 5).collect()} == want and len(want) > 20


@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (8, 8), (7, 33)])
def test_true_values_are_found_at_any_size(shape):
    mask = np.random.default_rng(1).random(shape) < 0.3
    for m in (mask, ~mask, mask & False, mask | True):
        assert [x.tolist() for x in resolve._where(m)] == [x.tolist() for x in np.nonzero(m)]
