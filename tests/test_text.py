import pytest
from pyspark.sql import functions as F

from lakeloom.functions import similarity as S
from lakeloom.functions import text as T


def values(spark, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


EQUAL = [
    ("John  Doe", "John Doe"), ("Mr. John Doe", "John Doe"), ("Dr. Sarah Chen", "Sarah Chen"), ("Prof. Smith", "Smith"), ("ACME Corp, Inc.", "ACME Corp"),
    ("Foo LLC", "Foo"), ("Bar Ltd.", "Bar"), ("U.S. EPA", "US EPA"), ("U.S.A.", "USA"), ("Bob Wilson (Site Lead)", "Bob Wilson"),
]
EXACT = {"Dr. Mr. X": "mr x", "Foo Inc Corp": "foo inc", "General Electric": "electric", "Jose Sa": "jose", "Inc": "inc", "Miss Universe Co.": "universe", "": ""}


def test_normalize_name(spark):
    left = values(spark, [a for a, _ in EQUAL], T.normalize_name(F.col("x")))
    right = values(spark, [b for _, b in EQUAL], T.normalize_name(F.col("x")))
    assert left == right
    assert values(spark, list(EXACT), T.normalize_name(F.col("x"))) == list(EXACT.values())
    assert values(spark, [None], T.normalize_name(F.col("x"))) == [""]
    a, b, c, d = values(spark, ["John Doe", "Jane Doe", "ACME Corp", "APEX Corp"], T.normalize_name(F.col("x")))
    assert a != b and c != d


def test_chunk_keys(spark):
    names = ["a/b.pdf_0", "x_y", "foo_1.pdf_12", "noext_3", "plain"]
    got = values(spark, names, T.split_chunk_key(F.col("x")))
    assert [tuple(r) for r in got] == [("a/b.pdf", 0), ("x_y", 0), ("foo_1.pdf", 12), ("noext", 3), ("plain", 0)]
    got = values(spark, names, T.page_ref(F.col("x")))
    assert [tuple(r) for r in got] == [("a/b.pdf", "1"), ("x_y", "1"), ("foo_1.pdf", "13"), ("noext_3", "1"), ("plain", "1")]
    assert values(spark, ["I:\\a\\b\\f.pdf_0", "/x/y.txt_3"], T.strip_drive(F.col("x"))) == ["a/b/f.pdf", "x/y.txt"]


def test_shingles_and_tokens(spark):
    got = values(spark, ["a b c d e f", "a b a", "", "A\u00a0B\tC d E"], T.shingles(F.col("x")))
    assert got == [["a b c d e", "b c d e f"], ["a", "b"], [], ["a b c d e"]]
    assert sorted(values(spark, ["the small x ring ring project"], T.blocking_tokens(F.col("x")))[0]) == ["ring", "small"]
    assert values(spark, ["  A \n b "], T.normalize_text(F.col("x"))) == ["a b"]
    assert values(spark, ["one two three", "a  b"], T.truncate_words(F.col("x"), 2)) == ["one two", "a  b"]


def test_reply_fields(spark):
    assert values(spark, ["```json\n{}\n```", " {} ", "```\n{}```"], T.strip_code_fence(F.col("x"))) == ["{}", "{}", "{}"]
    assert values(spark, ['["a","","b"]', "x", None, "[broken"], T.normalize_field(F.col("x"))) == ["a, b", "x", "", "[broken"]
    assert values(spark, ['["a",1]', "", None, "oops", "[]"], T.doc_count(F.col("x"))) == [2, 0, 0, 0, 0]


@pytest.mark.parametrize(
    ("a", "b", "jw", "ts", "combined"),
    [
        ("smith william", "william smith", 0.5495, 1.0, 1.0), ("michael a johnson", "michael johnson", 0.9765, 0.9375, 0.9765), ("john doe", "jon doe", 0.9667, 0.9333, 0.9667),
        ("james williams", "jane williams", 0.9414, 0.8889, 0.9414), ("baytown const", "baytown construction", 0.93, 0.7879, 0.93), ("r smith", "robert smith", 0.7893, 0.7368, 0.7893), ("r smith", "william smith", 0.3132, 0.5, 0.5),
    ],
)
def test_pair_scores(a, b, jw, ts, combined):
    x, y = S.jaro_winkler(a, b), S.token_sort_ratio(a, b)
    assert (round(x, 4), round(y, 4), round(max(x, y), 4)) == (jw, ts, combined)


def test_lcs_against_table():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for c in a:
            new = [0]
            for j, d in enumerate(b):
                new.append(row[j] + 1 if c == d else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    for a, b in [("", "x"), ("abcbdab", "bdcaba"), ("aaaa", "aa"), ("kitten", "sitting"), ("xyz" * 30, "zyx" * 30)]:
        assert S.lcs_length(a, b) == slow(a, b)
