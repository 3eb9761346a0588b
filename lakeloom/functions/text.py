"""Text rules as Column expressions; the same pattern strings serve the DuckDB forms."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Titles and organisation suffixes, each dropped once, in this order.
TITLES = (
    "mr mrs ms miss dr prof professor sir dame rev reverend hon honorable sgt sargent cpl corporal pvt private "
    "lt lieutenant cpt captain maj major col colonel gen general adm admiral eng engr atty esq"
).split()
SUFFIXES = "inc incorporated llc l.l.c ltd limited corp corporation co company plc lp l.p llp l.l.p pllc sa s.a gmbh ag pty na n.a".split()
# Words that never block.
STOP_TOKENS = (
    "the of and for in on at to a an is was are by from with as or not no its it be has had have "
    "project site phase section report letter inspection review meeting issue item area"
).split()

TITLE_PATTERN = "^" + "".join(rf"(?:{t}\.?\s+)?" for t in TITLES)
SUFFIX_PATTERN = r"^(.*?)" + "".join(rf"(?:[,\s]+{re.escape(s)}\.?\s*)?" for s in reversed(SUFFIXES)) + "$"
CHUNK_KEY = r"^(.*)_([0-9]+)$"
PAGE_KEY = r"^(.*\.\w+)_([0-9]+)$"


def split_chunk_key(name: Column) -> Column:
    """(base, index) of a chunk's file name; without a numeric suffix the whole name and 0."""
    has = name.rlike("(?s)" + CHUNK_KEY)
    return F.struct(
        F.when(has, F.regexp_extract(name, "(?s)" + CHUNK_KEY, 1)).otherwise(name).alias("base"),
        F.when(has, F.regexp_extract(name, "(?s)" + CHUNK_KEY, 2).cast("int")).otherwise(0).alias("idx"),
    )


def page_ref(name: Column) -> Column:
    """(filename, page) where a file extension precedes the suffix; the page counts from 1."""
    has = name.rlike("(?s)" + PAGE_KEY)
    return F.struct(
        F.when(has, F.regexp_extract(name, "(?s)" + PAGE_KEY, 1)).otherwise(name).alias("filename"),
        F.when(has, (F.regexp_extract(name, "(?s)" + PAGE_KEY, 2).cast("long") + 1).cast("string")).otherwise("1").alias("page"),
    )


def strip_drive(name: Column) -> Column:
    """A path with forward slashes, without chunk suffix, drive letter and leading slashes."""
    path = F.regexp_replace(F.regexp_replace(name, "(?s)" + CHUNK_KEY, "$1"), r"\\", "/")
    return F.regexp_replace(F.regexp_replace(path, "^[A-Za-z]:", ""), "^/+", "")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def token_count(text: Column) -> Column:
    """A quarter of the characters, rounded down."""
    return F.floor(F.length(text) / 4).cast("long")


def normalize_text(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)\s+", " "), "^ | $", "")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda w: w != "")


def shingles(text: Column, k: int = 5) -> Column:
    """Different runs of ``k`` words; of fewer words, the single words."""
    w = words(text)
    runs = lambda a: F.transform(F.sequence(F.lit(1), F.size(a) - (k - 1)), lambda i: F.array_join(F.slice(a, i, F.lit(k)), " "))
    return F.element_at(F.transform(F.array(w), lambda a: F.array_distinct(F.when(F.size(a) >= k, runs(a)).otherwise(a))), 1)


def normalize_name(name: Column) -> Column:
    """The key under which names of persons and organisations agree."""
    x = F.lower(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)^\s+|\s+$", ""))
    x = F.regexp_replace(x, r"(?U)\s*\(.*?\)\s*", " ")
    x = F.regexp_replace(x, "(?U)" + TITLE_PATTERN, "")
    x = F.regexp_replace(x, "(?Us)" + SUFFIX_PATTERN, "$1")
    x = F.regexp_replace(x, r"(?U)[^a-z0-9\s\-]", "")
    x = F.regexp_replace(x, r"(?U)\s*-\s*", "-")
    return F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), "^ | $", "")


def merge_key(name: Column) -> Column:
    """The normalized name, or the trimmed lower-case name where that is empty."""
    key = normalize_name(name)
    return F.when(key == "", F.lower(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)^\s+|\s+$", ""))).otherwise(key)


def blocking_tokens(key: Column) -> Column:
    stop = F.array(*[F.lit(t) for t in STOP_TOKENS])
    return F.array_distinct(F.filter(F.split(key, r"\s+"), lambda t: (F.length(t) >= 2) & ~F.array_contains(stop, t)))


def entity_text(name: Column, kind: Column, description: Column) -> Column:
    return F.trim(F.concat(name, F.lit(" ("), kind, F.lit("): "), F.coalesce(description, F.lit(""))))


def truncate_words(text: Column, n: int = 512) -> Column:
    """The first ``n`` words of a longer text; a shorter one as it is."""
    w = F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")
    return F.element_at(F.transform(F.array(w), lambda a: F.when(F.size(a) > n, F.array_join(F.slice(a, 1, n), " ")).otherwise(text)), 1)


def doc_count(json: Column) -> Column:
    """Elements of a JSON array; 0 for null, empty, broken or other JSON."""
    return F.coalesce(F.json_array_length(json), F.lit(0))


def strip_code_fence(reply: Column) -> Column:
    """A model's reply without the fence around its JSON."""
    x = F.regexp_replace(reply, r"(?U)^\s+|\s+$", "")
    x = F.regexp_replace(F.regexp_replace(x, "^```json", ""), "^```", "")
    return F.regexp_replace(F.regexp_replace(x, "```$", ""), r"(?U)^\s+|\s+$", "")


def normalize_field(value: Column) -> Column:
    """'' for null; the non-empty items of a list joined by ', '; otherwise the value."""
    items = F.from_json(value, "array<string>")
    return F.when(value.isNull(), "").when(value.startswith("["), F.coalesce(F.array_join(F.filter(items, lambda x: x.isNotNull() & (x != "")), ", "), value)).otherwise(value)
