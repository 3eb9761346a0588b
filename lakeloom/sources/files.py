"""File sources: text and PDF folders, decoding, overlapping line chunks, pluggable models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.text import split_chunk_key, token_count


def scan_binary(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(path, length, content) of the files that match, small files first within a partition."""
    return spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{glob}").select("path", "length", "content").sortWithinPartitions("length")


def scan_txt(spark: SparkSession, folder: str) -> DataFrame:
    """Text files three levels down: */TEXT/*/*.txt."""
    return scan_binary(spark, folder, "*/TEXT/*/*.txt")


def scan_pdf(spark: SparkSession, folder: str) -> DataFrame:
    """PDF files directly in the folder."""
    return scan_binary(spark, folder, "*.pdf")


def decode_text(content: Column) -> Column:
    """UTF-8, or Latin-1 where that is invalid; all line ends as one line feed."""
    return F.regexp_replace(F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1")), "\r\n?", "\n")


def line_chunks(docs: DataFrame, path_col: str = "source_path", text_col: str = "text", size: int = 500, overlap: int = 50) -> DataFrame:
    """Windows of ``size`` lines every ``size - overlap`` lines; blank windows are dropped and keep their number.

    Adds chunk_index, filename, text and token_count; null texts give no chunk.
    """
    step = max(1, size - overlap)
    lines = F.split(F.col(text_col), "\n", -1)
    starts = lambda a: F.sequence(F.lit(0), F.size(a) - 1, F.lit(step))
    made = F.element_at(
        F.transform(F.array(lines), lambda a: F.transform(starts(a), lambda i: F.struct(F.floor(i / step).cast("int").alias("chunk_index"), F.array_join(F.slice(a, i + 1, F.lit(size)), "\n").alias("chunk")))), 1
    )
    out = docs.where(F.col(text_col).isNotNull()).withColumn("c", F.explode(made)).where(F.col("c.chunk").rlike(r"(?U)\S"))
    out = out.withColumn(text_col, F.col("c.chunk")).withColumn("chunk_index", F.col("c.chunk_index")).drop("c")
    return out.withColumn("filename", F.concat_ws("_", F.col(path_col), F.col("chunk_index"))).withColumn("token_count", token_count(F.col(text_col)))


def pdf_pages(files: DataFrame, extractor: Callable[[bytes], list[str]]) -> DataFrame:
    """(source_path, chunk_index, filename, text, token_count) of the pages with text; ``error`` where a file fails.

    ``extractor`` turns a file's bytes into its pages' texts; a failing file gives one row with its error.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    rows += [(path, i, t, None) for i, t in enumerate(extractor(bytes(content))) if t]
                except Exception as e:  # noqa: BLE001 - one bad file must not end the others
                    rows.append((path, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["source_path", "chunk_index", "text", "error"]).astype({"chunk_index": "Int64"})

    pages = files.select("path", "content").mapInPandas(run, "source_path string, chunk_index int, text string, error string")
    return pages.withColumn("filename", F.concat_ws("_", "source_path", "chunk_index")).withColumn("token_count", token_count(F.col("text")))


def resume_files(files: DataFrame, chunks: DataFrame, path_col: str = "path") -> DataFrame:
    """Files none of whose chunks is stored yet."""
    done = chunks.select(split_chunk_key(F.col("filename"))["base"].alias(path_col)).distinct()
    return files.join(done, path_col, "left_anti")


def map_texts(df: DataFrame, text_col: str, out_col: str, model: Callable[[list[str]], list], out_type: str, batch: int = 64, error_col: str | None = None) -> DataFrame:
    """Add a column that a pluggable model computes from texts, in batches; the model is loaded once per task.

    With ``error_col`` a failing text does not end the job: its batch is asked again text by text, and the text
    that fails gets null and the error's type and message.
    """

    def one(text: str) -> tuple:
        try:
            return model([text])[0], None
        except Exception as e:  # noqa: BLE001 - one bad text must not end the others
            return None, f"{type(e).__name__}: {e}"

    def many(texts: list[str]) -> list[tuple]:
        try:
            return [(v, None) for v in model(texts)]
        except Exception:
            if error_col is None:
                raise
            return [one(t) for t in texts]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = part[text_col].tolist()
            got = [v for i in range(0, len(texts), batch) for v in many(texts[i : i + batch])]
            part[out_col] = pd.Series([v for v, _ in got], dtype=object, index=part.index)
            if error_col:
                part[error_col] = pd.Series([e for _, e in got], dtype=object, index=part.index)
            yield part

    out = df.withColumn(out_col, F.lit(None).cast(out_type))
    return df.mapInPandas(run, (out.withColumn(error_col, F.lit(None).cast("string")) if error_col else out).schema)


def embed_texts(df: DataFrame, text_col: str, out_col: str, model: Callable[[list[str]], list[list[float]]], batch: int = 64) -> DataFrame:
    """Add the texts' embeddings, of length 1; a vector of zeros stays so."""
    raw = map_texts(df, text_col, "_raw", model, "array<double>", batch)
    length = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda acc, x: acc + x * x))
    return raw.withColumn(out_col, F.transform("_raw", lambda x: F.when(length > 0, x / length).otherwise(0.0))).drop("_raw")


def probe_model(model: Callable[[list[str]], list]) -> None:
    """Raise before a run rather than fail in each task."""
    if len(model(["probe"])) != 1:
        raise ValueError("the model must give one result a text")
