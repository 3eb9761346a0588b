"""Host-level quality rules, built from native expressions only.

Per document a few counts are taken and rules are judged: two hard ones, whose
failure is ``base_failed``, and three soft ones.  Per host the failures are added
up, rule by rule and of any rule, and each rate is shrunk towards a beta prior
that is fitted to all hosts by moments.  The posteriors are the hosts' verdicts,
which are joined back to the documents:

* a host whose shrunk rate of documents with any failure is over ``host_limit``
  is condemned: all its documents go;
* a soft rule is waived on a host that breaks it credibly less often than the
  corpus does (posterior mean and ``credible`` standard deviations below the corpus
  rate): such breaches are odd pages of a sound host, and stay;
* elsewhere the soft rule binds, and the documents that break it go.

A host of few documents is close to the prior, so it is neither condemned nor
waived.  Null texts count as empty, a null host is a host of its own, repeated rows
are judged one by one, a rate exactly at a limit neither condemns nor waives,
texts of any length are read whole, an empty table gives an empty result, and columns of
the input other than the three named ones, whatever their names, are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.exprs import let, words
from lakeloom.plans.storage import materialize

SYMBOLS = "#*$%&|<>"
#: Above so many different repeated windows a sort replaces the scan of a short list.
_SHORT = 64


def hard_rules() -> dict[str, Column]:
    n = F.col
    return {"short": n("n_words") < 50, "repeats": 100 * n("n_repeat_words") > 50 * n("n_words")}


def soft_rules() -> dict[str, Column]:
    n = F.col
    return {
        "symbols": 10 * n("n_symbols") > n("n_words"),
        "lines": 10 * n("n_dup_lines") > 3 * n("n_lines"),
        "length": (n("word_chars") < 2 * n("n_words")) | (n("word_chars") > 15 * n("n_words")),
    }


def _covered(at: Column) -> Column:
    """Words covered by the windows of three that begin at the ascending positions ``at``."""
    step = lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"))
    return F.aggregate(at, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), step, lambda acc: acc["n"])


def _by_list(g: Column, twice: Column) -> Column:
    return _covered(F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: F.array_contains(twice, F.get(g, i))))


def _by_sort(g: Column) -> Column:
    placed = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    same = lambda s, e, k: F.coalesce(F.get(s, k)["x"] == e["x"], F.lit(False))
    return let(placed, lambda s: _covered(F.sort_array(F.transform(F.filter(s, lambda e, k: same(s, e, k - 1) | same(s, e, k + 1)), lambda e: e["i"]))))


def _repeated(w: Column) -> Column:
    windows = F.when(
        F.size(w) > 2,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    twice = lambda s: F.array_distinct(F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1) == x, F.lit(False))))
    some = lambda g: let(let(F.sort_array(g), twice), lambda d: F.when(F.size(d) <= _SHORT, _by_list(g, d)).otherwise(_by_sort(g)))
    return let(windows, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(some(g)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host and the counts of every whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _repeated(w).cast("long").alias("n_repeat_words"),
        ),
    )
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), counted.alias("c"), by_line.alias("l"), symbols.alias("n_symbols")).select("doc_id", "host", "c.*", "l.*", "n_symbols")


def host_rates(judged: DataFrame, rules: list[str]) -> tuple[DataFrame, dict[str, float]]:
    """Per host and rule the failure rate, shrunk to a beta prior fitted to all hosts by moments, and its posterior
    standard deviation; and the corpus rate of each rule."""
    by_host = judged.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col(f"bad_{r}").cast("long")).alias(f"f_{r}") for r in rules])
    # One row of sums over hosts: rows, rows squared, hosts, and per rule the failures and n p^2.
    sums = [F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.count("*").alias("hosts")]
    for r in rules:
        sums += [F.sum(f"f_{r}").alias(f"f_{r}"), F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n")).alias(f"q_{r}")]
    t = by_host.agg(*sums).first()
    rows = t["rows"] or 1
    out, corpus = by_host, {}
    for r in rules:
        m = min(max((t[f"f_{r}"] or 0) / rows, 1e-6), 1 - 1e-6)
        noise = m * (1 - m)
        # Variance between hosts: what their weighted spread exceeds that of one common rate.
        between = ((t[f"q_{r}"] or 0.0) - rows * m * m - noise * (t["hosts"] - 1)) / max(rows - (t["squares"] or 0) / rows, 1.0)
        weight = max(noise / max(between, noise * 1e-4) - 1, 1.0)
        rate = F.col(f"rate_{r}")
        out = out.withColumn(f"rate_{r}", (F.col(f"f_{r}") + F.lit(m * weight)) / (F.col("n") + F.lit(weight))).withColumn(f"sd_{r}", F.sqrt(rate * (1 - rate) / (F.col("n") + F.lit(weight + 1))))
        corpus[r] = m
    return out, corpus


def host_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", host_limit: float = 0.5, credible: float = 1.645) -> DataFrame:
    """Counts, rule failures, host rates and the verdict of every document."""
    hard, soft = hard_rules(), soft_rules()
    broken = {f"bad_{r}": F.coalesce(c, F.lit(False)) for r, c in (hard | soft).items()}
    either = lambda names: functools.reduce(Column.__or__, [F.col(f"bad_{r}") for r in names])
    judged = materialize(
        measure(docs, id_col, text_col, host_col).withColumns(broken).withColumn("base_failed", either(hard)).withColumn("bad_any", either(hard | soft)),
        "quality",
    )
    hosts, corpus = host_rates(judged, [*soft, "any"])
    verdicts = {f"waived_{r}": F.col(f"rate_{r}") + credible * F.col(f"sd_{r}") < F.lit(corpus[r]) for r in soft}
    hosts = hosts.withColumns(verdicts).withColumn("condemned", F.col("rate_any") > host_limit).select(F.col("host").alias("at"), *verdicts, "condemned", "rate_any")
    breach = functools.reduce(Column.__or__, [F.col(f"bad_{r}") & ~F.col(f"waived_{r}") for r in soft])
    return judged.join(hosts, F.col("host").eqNullSafe(F.col("at")), "left").drop("at").withColumn("kept", ~F.col("base_failed") & ~F.col("condemned") & ~breach)
