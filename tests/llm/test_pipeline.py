import random

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import chat, contain, html, jaccard, pieces, quality, secrets, shards, spans, toxicity
from tests.llm.test_llm import DOC, prose

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def write(spark, at, docs, labels, items):
    spark.createDataFrame(docs, DOC).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")


def test_stages(spark, tmp_path):
    rng = random.Random(20)
    texts = [prose(rng, 80, 5000) for _ in range(300)]
    toxic = set(range(0, 120, 2))
    for i in toxic:
        w = texts[i].split()
        for _ in range(4):
            w.insert(rng.randrange(80), rng.choice(["idiotxx", "scumyy"]))
        texts[i] = " ".join(w)
    items = [prose(rng, 30, 5000) for _ in range(3)]
    texts[150] = texts[151]
    near = texts[153].split()
    near[0] = "changed"
    texts[155] = " ".join(near)
    texts[160] += " " + items[1]
    texts[161] += ' token = "abcdefgh12345678"'
    texts += ["", None]
    labels = [(i, 1, int(i in toxic)) for i in range(140)]
    write(spark, tmp_path, [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], labels, list(enumerate(items)))
    docs, sizes, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), [], []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == corpus_pipeline.COLUMNS
        rows = {r["doc_id"]: r for r in docs.collect()}
        sizes.append(len(rows)), seen.append(rows)
    assert set(seen[0]) == set(range(302)) - toxic
    assert set(seen[0]) - set(seen[1]) == {151, 155} and set(seen[1]) - set(seen[2]) == {160} and set(seen[2]) == set(seen[3])
    assert seen[3][161]["text"].endswith(' [SECRET]"') and seen[3][161]["n_chars"] == len(seen[3][161]["text"]) and seen[3][301]["text"] is None
    assert all(seen[3][i]["text"] == texts[i] for i in seen[3] if i != 161)
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = pieces.decode_pieces(out).collect()
    assert {r["doc_id"] for r in got} == set(seen[3]) and all(r["decoded"] == (seen[3][r["doc_id"]]["text"] or "") for r in got)


def test_empty_corpus(spark, tmp_path):
    write(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_with_clashing_names(spark):
    extra = "key host bucket n rep token a b m shared label spans base tokens score held_out shard slot component_id shingles winner path range entries at w l c part".split()
    df = spark.createDataFrame([(i, f"text number {i} with token=abcdefgh{i}", "en", "s", 9) for i in range(6)], DOC)
    df = df.withColumns({x: F.lit(1) for x in extra if x not in df.columns})
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    items = spark.createDataFrame([(1, "a b c d e f", 1)], "item_id long, text string, doc_id int")
    assert secrets.scan_secrets(df).count() == 6 and contain.contained_items(df, items).count() == 0 and shards.balanced_shards(df, 3).count() == 6
    assert spans.drop_repeated_spans(df).count() == 6 and quality.host_quality(df).count() == 6 and toxicity.toxicity_scores(df, labels).count() == 6
    assert jaccard.jaccard_classes(df).count() == 6 and pieces.sample_segmentations(df, k=1).count() == 6
    page = spark.createDataFrame([(1, "http://h", "<p>x", "w", "p")], "page_id long, url string, html string, winner string, path string")
    turn = spark.createDataFrame([(1, 0, "user", "x", 1, 2)], "conv_id long, turn long, role string, text string, plain int, shown int")
    assert html.extract_pages(page).first()["text"] == "x" and chat.format_chats(turn).first()["round_trip"]


def test_all_null_rows(spark):
    df = spark.createDataFrame([(None, None, None, None, None)] * 2, DOC)
    none = spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(None, None)], "item_id long, text string")
    for out in (secrets.scan_secrets(df), shards.balanced_shards(df, 2), spans.drop_repeated_spans(df), quality.host_quality(df), toxicity.toxicity_scores(df, none), jaccard.jaccard_classes(df), pieces.sample_segmentations(df)):
        assert out.count() == 2
    assert contain.contained_items(df, items).count() == 0
    assert html.extract_pages(spark.createDataFrame([(None, None, None)], "page_id long, url string, html string")).first()["text"] == ""
    assert chat.format_chats(spark.createDataFrame([(None, None, None, None)], "conv_id long, turn long, role string, text string")).first()["round_trip"]


def test_very_long_texts_and_repeated_rows(spark):
    """Whole texts, and equal results for rows that repeat an id."""
    rng = random.Random(23)
    item = prose(rng, 40, 5000)
    long = prose(rng, 40_000, 5000) + " " + item + " token=abcdefgh12345678 " + prose(rng, 20_000, 5000)
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in [(1, long), (1, long), (2, long), (3, "short"), (3, "short")]], DOC)
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    spans_of = [(r["doc_id"], [(s["start"], s["end"]) for s in r["spans"]]) for r in secrets.scan_secrets(df).collect()]
    at = long.index("token=")
    assert sorted(spans_of) == [(1, [(at, at + 22)])] * 2 + [(2, [(at, at + 22)])] + [(3, [])] * 2
    assert {(r["doc_id"], r["item_id"]) for r in contain.contained_items(df, items).collect()} == {(1, 7), (2, 7)}
    placed = shards.balanced_shards(df, 2).collect()
    assert len(placed) == 5 and len({r["shard"] for r in placed if r["doc_id"] < 3}) == 1
    cut = sorted((r["doc_id"], r["n_removed"] > 0) for r in spans.drop_repeated_spans(df).collect())
    assert cut == [(1, False), (1, False), (2, True), (3, False), (3, False)]
    judged = {(r["doc_id"], r["n_words"], r["kept"]) for r in quality.host_quality(df).collect()}
    assert {(d, n) for d, n, _ in judged} == {(1, 60_041), (2, 60_041), (3, 1)}
    assert len({(r["doc_id"], r["score"]) for r in toxicity.toxicity_scores(df, labels).collect()}) == 3
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.jaccard_classes(df).collect()} == {(1, 1), (2, 1), (3, 3)}
    got = pieces.sample_segmentations(df, k=2)
    assert got.where("round_trip").count() == got.count() == 10 and got.select("doc_id", "sample", "pieces").distinct().count() == 6


def test_stages_ignore_extra_columns_and_repeat_rows(spark, tmp_path):
    rng = random.Random(24)
    texts = [prose(rng, 60, 5000) for _ in range(8)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    write(spark, tmp_path, rows, [(1, 1, 0)], [(1, texts[3])])
    df = spark.createDataFrame(rows + rows[:2], DOC).withColumns({c: F.lit(1) for c in ("score", "spans", "rep", "component_id", "item_id", "held_out", "kept_0")})
    for (name, stage), left in zip(corpus_pipeline.STAGES, (10, 10, 9, 10, 20), strict=True):
        out = stage(spark, df, str(tmp_path))
        assert out.count() == left, name
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == corpus_pipeline.COLUMNS


def test_ties(spark):
    """Equal texts, sizes, scores and sources: results do not depend on the order of the rows."""
    df = spark.createDataFrame([(i, "one two three four five six seven. " * 3, "en", "s", 9) for i in range(12)], DOC)
    for of in (lambda d: shards.balanced_shards(d, 4), spans.drop_repeated_spans, quality.host_quality, jaccard.jaccard_classes, lambda d: pieces.sample_segmentations(d, k=2)):
        a, b = (sorted(map(str, of(d).collect())) for d in (df.repartition(3), df.orderBy(F.desc("doc_id")).coalesce(1)))
        assert a == b
