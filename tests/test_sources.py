import sqlite3

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeloom.sources import files, sqlite, tables
from lakeloom.streaming.ingest import ingest


def test_text_folder(spark, tmp_path):
    at = tmp_path / "box" / "TEXT" / "one"
    at.mkdir(parents=True)
    (at / "a.txt").write_bytes("caf\u00e9\r\nx\ry".encode())
    (at / "b.txt").write_bytes("caf\u00e9".encode("latin-1"))
    (at / "c.pdf").write_bytes(b"no")
    got = files.scan_txt(spark, str(tmp_path)).select(files.decode_text(F.col("content")).alias("t"))
    assert {r[0] for r in got.collect()} == {"caf\u00e9\nx\ny", "caf\u00e9"}


def test_pdf_pages_isolates_errors(spark):
    def pages(content):
        if content == b"bad":
            raise ValueError("broken")
        return content.decode().split("|")

    df = spark.createDataFrame([("x.pdf", bytearray(b"p0||p2")), ("y.pdf", bytearray(b"bad"))], "path string, content binary")
    good, bad = tables.split_errors(files.pdf_pages(df, pages))
    assert {(r["filename"], r["text"]) for r in good.collect()} == {("x.pdf_0", "p0"), ("x.pdf_2", "p2")}
    assert [r["error"] for r in bad.collect()] == ["ValueError: broken"]


def test_models(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "i int, text string")
    got = files.map_texts(df, "text", "v", lambda xs: [[float(len(x))] for x in xs], "array<float>", batch=3)
    assert {r["v"][0] for r in got.collect()} == {2.0}
    with pytest.raises(ValueError, match="one result"):
        files.probe_model(lambda xs: [])


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE chunks (chunk_id INTEGER PRIMARY KEY, filename TEXT, score REAL)")
        con.executemany("INSERT INTO chunks VALUES (?, ?, ?)", [(i, f"f{i}", i / 2 if i % 2 else None) for i in range(1, 101)])
        con.execute("CREATE TABLE empty (a INTEGER)")
    df = sqlite.read_sqlite(spark, path, "chunks", 4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100 and df.agg(F.sum("score")).first()[0] == 1250.0
    assert sqlite.read_sqlite(spark, path, "empty").count() == 0
    assert sqlite.tables(path) == {"chunks": ["chunk_id", "filename", "score"], "empty": ["a"]}


def test_table_sinks(spark, tmp_path):
    at = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    tables.write_table(df, at)
    with pytest.raises(AnalysisException):
        tables.write_table(df, at)
    tables.append_table(df, at)
    assert spark.read.parquet(at).count() == 2
    tables.write_table(df, at, overwrite=True)
    assert spark.read.parquet(at).count() == 1
    state = str(tmp_path / "state")
    assert not tables.stage_done(spark, state, "hash")
    tables.mark_stage(spark, state, "hash", 5)
    assert tables.stage_done(spark, state, "hash") and not tables.stage_done(spark, state, "lsh")
    tables.mark_stage(spark, state, "lsh", 2)
    tables.reset_stages(spark, state, ["hash"])
    assert not tables.stage_done(spark, state, "hash") and tables.stage_done(spark, state, "lsh")
    tables.reset_stages(spark, state)
    assert not tables.stage_done(spark, state, "lsh")


def test_delete_like_is_like(spark):
    df = spark.createDataFrame([("PNA_0001.pdf",), ("pnax0001.txt",), ("other",), (None,)], "filename string")
    assert {r[0] for r in tables.delete_like(df, "filename", "pna_0001").collect()} == {"other", None}
    assert tuple(tables.delete_counts(df, "filename", "pna_0001").first()) == (4, 2, 2)


def test_canonical(spark):
    old = spark.createDataFrame([("1", None)], "chunk_id string, type string")
    assert tables.canonical(old, {"document_id": "?", "type": "unknown", "cc": ""}).first().asDict() == {"document_id": "1", "type": "unknown", "cc": ""}


def test_stream_ingest_reads_each_file_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("\n".join(map(str, range(30))))
    args = (str(src), str(tmp_path / "out"), str(tmp_path / "ck"))
    ingest(spark, *args, size=20, overlap=5).awaitTermination()
    (src / "b.txt").write_text("x")
    ingest(spark, *args, size=20, overlap=5).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 3 and got.select("source_path").distinct().count() == 2
