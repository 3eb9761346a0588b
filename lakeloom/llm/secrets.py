"""Secret scan with a randomness battery, native expressions only.

Three fixed patterns give the base spans.  The battery adds spans of further
tokens of ``MIN_TOKEN`` characters or more:

* names and values around ``=`` are tokens of their own, and so are the parts between
  ``/`` of what fits no encoding as a whole;
* the encoding is inferred from the alphabet of the token;
* chi-squared uniformity over that alphabet, runs above and below its middle
  and the lag-one serial correlation are each standard normal for random text;
  a token that any of them rejects (after Bonferroni, at ``level``) is no secret;
* under the null of ordinary text the same statistics have other moments, all
  functions of the length: letter coincidences are frequent, the character
  class changes rarely, and few letters fall into a narrow alphabet.  The least
  of the three tail bounds, times three, is the token's p-value;
* Benjamini-Hochberg controls the false discoveries at ``fdr`` in each stratum
  of encoding and length.  Only a histogram of p-values leaves the executors
  (at most ``BINS`` bins for each of a few dozen strata).

Spans are [start, end) in code points; spans that begin at one place are listed by kind.
Null texts count as empty, texts of any length are scanned whole, repeated rows are scanned
one by one, tokens of equal p-value are accepted together, an empty table gives an empty
result, and columns that are not named, whatever their names, are ignored.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.exprs import let
from lakeloom.plans.storage import materialize

# The patterns of the base scan.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

#: Below this length none of the tests can tell random from ordinary text at the false discovery rate: 11 changes of class
#: at most, three standard deviations, before the correction for the number of tokens.
MIN_TOKEN = 12
_WORD, _LONG = "A-Za-z0-9", f"{{{MIN_TOKEN},}}+"
#: A run of token characters with its padding; one that mixes + or / with - or _, which no encoding does, falls into
#: its parts between /, and such a part into those between +.  A = inside parts names and values.
TOKEN = (
    rf"(?<![{_WORD}_-])(?=[{_WORD}+/_-]{{{MIN_TOKEN}}})"
    rf"(?:(?<![+/])[{_WORD}+/]{_LONG}(?![_-])|(?<!\+)[{_WORD}+]{_LONG}(?![_-])|[{_WORD}_-]{_LONG})=*"
)
BINS = 400
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: name, pattern of the token without padding, alphabet, share of ordinary characters inside the alphabet.
ENCODINGS = (
    ("digits", r"\A[0-9]+\z", _DIGITS, 1.0),
    ("hex", r"\A[0-9a-f]+\z", _DIGITS + "abcdef", 0.35),
    ("HEX", r"\A[0-9A-F]+\z", _DIGITS + "ABCDEF", 0.35),
    ("base32", r"\A[A-Z2-7]+\z", _UPPER + "234567", 1.0),
    ("base36", r"\A[a-z0-9]+\z", _DIGITS + _LOWER, 1.0),
    ("base62", r"\A[A-Za-z0-9]+\z", _DIGITS + _LOWER + _UPPER, 1.0),
    ("base64", r"\A[A-Za-z0-9+/]+\z", _UPPER + _LOWER + _DIGITS + "+/", 1.0),
    ("base64url", r"\A[A-Za-z0-9_-]+\z", _UPPER + _LOWER + _DIGITS + "-_", 1.0),
)
#: Ordinary text: chance that two letters agree, that three agree, and that neighbours differ in class.
COINCIDE, COINCIDE3, CHANGE = 0.0667, 0.0056, 0.15


def prefix_sums(a: Column, chunk: int = 256) -> Column:
    """The sums of all elements before each, by chunks so that the work stays far below quadratic."""
    run = lambda xs, base: F.aggregate(
        xs,
        F.struct(base.cast("int").alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")),
        lambda acc: acc["out"],
    )
    pieces = F.transform(F.sequence(F.lit(0), ((F.size(a) - 1) / chunk).cast("int")), lambda c: F.slice(a, c * chunk + 1, F.lit(chunk)))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda acc, x: acc + x)
    return let(pieces, lambda p: F.flatten(F.zip_with(p, run(F.transform(p, total), F.lit(0)), lambda xs, base: run(xs, base))))


def find(text: Column, pattern: str, value: int = 0) -> Column:
    """(start, end, value) of the leftmost non-overlapping matches; value is a group of the pattern."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def spans(p: Column) -> Column:
        return let(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda m: let(
                F.zip_with(F.slice(p, 1, F.size(m)), m, lambda x, y: F.length(x) + F.length(y)),
                lambda n: let(
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(value)),
                    lambda v: F.transform(
                        prefix_sums(n),
                        lambda at, i: F.struct((at + F.length(F.get(p, i))).alias("start"), (at + F.get(n, i)).alias("end"), F.get(v, i).alias("value")),
                    ),
                ),
            ),
        )

    return let(F.split(text, pattern, -1), lambda p: F.when(F.size(p) > 1, spans(p)).otherwise(none))


def _upper(z: Column) -> Column:
    """A bound on the upper normal tail."""
    return F.when(z > 0, 0.5 * F.exp(-z * z / 2)).otherwise(F.lit(1.0))


def _choose(core: Column, pick) -> Column:
    out = F.lit(None)
    for e in reversed(ENCODINGS):
        out = F.when(core.rlike(e[1]), F.lit(pick(e))).otherwise(out)
    return out


def battery(token: Column) -> Column:
    """(encoding, band, bin, random) of a token; null encoding for tokens that are never judged."""
    core = F.regexp_replace(token, "=+$", "")

    def stats(t: Column, name: Column, alphabet: Column, inside: Column) -> Column:
        n = F.length(t).cast("double")
        k = F.length(alphabet).cast("double")
        chars = F.split(t, "")
        squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc + F.pow(F.length(t) - F.length(F.replace(t, c, F.lit(""))), F.lit(2.0)))
        codes = F.transform(chars, lambda c: F.position(c, alphabet) - 1)
        turns = lambda xs: F.aggregate(F.zip_with(xs, F.slice(xs, F.lit(2), F.size(xs) - 1), lambda x, y: F.when(x != y, 1).otherwise(0)), F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))
        halves = lambda xs: F.transform(xs, lambda x: 2 * x >= k)
        serial = lambda xs: F.aggregate(
            F.zip_with(xs, F.slice(xs, F.lit(2), F.size(xs) - 1), lambda x, y: (x - (k - 1) / 2) * (y - (k - 1) / 2)), F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0))
        )
        kinds = F.transform(chars, lambda c: F.when(c.between("a", "z"), 1).when(c.between("A", "Z"), 2).when(c.between("0", "9"), 3).otherwise(4))
        measured = F.struct(
            squares.alias("squares"),
            let(codes, lambda x: F.struct(let(halves(x), turns).cast("double").alias("runs"), serial(x).alias("serial"))).alias("c"),
            let(kinds, turns).cast("double").alias("classes"),
        )

        def judge(m: Column) -> Column:
            chi = (k / n * m["squares"] - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
            runs = F.abs(m["c"]["runs"] - (n - 1) / 2) / F.sqrt((n - 1) / 4)
            serial_z = F.abs(m["c"]["serial"]) / ((k * k - 1) / 12 * F.sqrt(n - 1))
            random = F.least(F.lit(1.0), 3 * F.least(_upper(chi), 2 * _upper(runs), 2 * _upper(serial_z)))
            pairs, triples = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
            agree = (m["squares"] - n) / 2
            spread = F.sqrt(pairs * (COINCIDE - COINCIDE**2) + 6 * triples * (COINCIDE3 - COINCIDE**2))
            even = _upper((pairs * COINCIDE - agree) / spread)
            mixed = _upper((m["classes"] - (n - 1) * CHANGE) / F.sqrt((n - 1) * CHANGE * (1 - CHANGE)))
            p = F.least(F.lit(1.0), 3 * F.least(even, mixed, F.pow(inside, n)))
            return F.struct(
                name.alias("encoding"),
                F.floor(2 * F.log2(n)).cast("int").alias("band"),
                F.least(F.lit(BINS - 1), F.floor(-4 * F.log10(F.greatest(p, F.lit(1e-300))))).cast("int").alias("bin"),
                random.alias("random"),
            )

        return let(measured, judge)

    kinds = F.struct(_choose(core, lambda e: e[0]).alias("name"), _choose(core, lambda e: e[2]).alias("alphabet"), _choose(core, lambda e: e[3]).alias("inside"))
    none = F.lit(None).cast("struct<encoding:string,band:int,bin:int,random:double>")
    judged = lambda t, e: F.when(e["name"].isNull() | (e["name"] == "digits") | (F.length(t) < MIN_TOKEN), none).otherwise(stats(t, e["name"], e["alphabet"], e["inside"]))
    return let(core, lambda t: let(kinds, lambda e: judged(t, e)))


def thresholds(counts: list[tuple[str, int, int, int]], fdr: float) -> dict[tuple[str, int], int]:
    """Per stratum the least bin that Benjamini-Hochberg accepts; a bin counts with its largest p-value."""
    strata: dict[tuple[str, int], dict[int, int]] = defaultdict(dict)
    for encoding, band, b, n in counts:
        strata[encoding, band][b] = n
    out = {}
    for s, bins in strata.items():
        total, so_far = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            so_far += bins[b]
            if total * 10 ** (-b / 4) <= fdr * so_far:
                out[s] = b
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.01, level: float = 0.001, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, and ``spans``: array of (start, rank, end, kind) by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ranked = lambda spans, rank: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))
    base = F.array_sort(
        F.concat(ranked(F.filter(find(text, ASSIGN, 1), lambda s: F.length(s["value"]) >= 8), 0), ranked(find(text, ACCESS), 1), ranked(find(text, HEX), 2))
    )
    tokens = F.transform(find(text, TOKEN), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), battery(s["value"]).alias("b")))
    found = docs.select(F.col(id_col).alias("doc_id"), *keep, base.alias("base"), tokens.alias("tokens"))
    apart = F.filter("tokens", lambda t: t["b"].isNotNull() & ~F.exists("base", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    found = materialize(found.withColumn("tokens", apart), "secrets")
    counts = found.select(F.explode("tokens").alias("t")).groupBy("t.b.encoding", "t.b.band", "t.b.bin").count()
    least = thresholds([(r["encoding"], r["band"], r["bin"], r["count"]) for r in counts.collect()], fdr)  # at most strata x BINS rows
    known = F.map_from_arrays(F.array(*[F.lit(f"{e}/{b}") for e, b in sorted(least)]), F.array(*[F.lit(least[x]) for x in sorted(least)])) if least else None
    secret = lambda t: (t["b"]["random"] >= level) & F.coalesce(t["b"]["bin"] >= F.try_element_at(known, F.concat_ws("/", t["b"]["encoding"], t["b"]["band"].cast("string"))), F.lit(False))
    added = ranked(F.filter("tokens", secret), 3) if least else F.array().cast("array<struct<start:int,rank:int,end:int>>")
    every = F.array_sort(F.concat(F.col("base"), added))
    name = F.array(*[F.lit(k) for k in KINDS])
    return found.select("doc_id", *keep, F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), F.get(name, s["rank"]).alias("kind"))).alias("spans"))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).alias("out"),
    )
    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    return F.when(F.size(spans) > 0, done).otherwise(text)
