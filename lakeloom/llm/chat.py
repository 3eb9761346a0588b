r"""Chat formatting with a grammar round trip, native expressions only.

A turn is rendered as ``<|im_start|>ROLE\nTEXT<|im_end|>\n``.  Every turn is
first rendered as it is and read back by a deterministic parser; a turn whose
role or text does not come back is rendered again with its content escaped,
and the whole conversation is parsed once more and compared with its source.

Escaping puts one more backslash between ``<`` and ``|``, however many are
there; the parser takes one away.  So no escaped text holds ``<|``, and the
two steps are inverse.  A role's line breaks and backslashes become ``\n`` and
``\s``.

Null texts and roles count as empty, ties in ``turn`` are ordered by role and
text, repeated rows are turns of their own, rows without conv_id form one
conversation, an empty table gives an empty result and other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.exprs import let

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def _pieces(rendered: Column) -> Column:
    return let(F.split(rendered, r"<\|im_start\|>", -1), lambda s: F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0))))


def _body(piece: Column) -> Column:
    return F.regexp_extract(piece, r"(?s)\A[^\n]*\n(.*?)<\|im_end\|>", 1)


def parse(rendered: Column) -> Column:
    """Turns (role, text) of a rendered conversation; what breaks the grammar gives other turns than were meant."""
    return F.transform(_pieces(rendered), lambda p: F.struct(unescape_role(F.regexp_extract(p, r"\A[^\n]*", 0)).alias("role"), unescape(_body(p)).alias("text")))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, formatted, the turns read back from it, the number of escaped turns, and whether source and reading agree."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    plain = let(parse(render(role, text)), lambda p: (F.size(p) == 1) & F.coalesce((F.get(p, 0)["role"] == role) & (F.get(p, 0)["text"] == text), F.lit(False)))
    one = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), plain.alias("plain"))
    shown = F.when(F.col("plain"), render(F.col("role"), F.col("text"))).otherwise(render(escape_role(F.col("role")), escape(F.col("text"))))
    listed = one.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "plain", shown.alias("shown")))).alias("t"))
    whole = listed.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["shown"]), "").alias("formatted"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("source"),
        F.size(F.filter("t", lambda x: ~x["plain"])).cast("long").alias("n_escaped"),
    )
    read = whole.withColumn("turns", parse(F.col("formatted")))
    return read.select("conv_id", "formatted", "turns", "n_escaped", (F.col("turns") == F.col("source")).alias("round_trip"))


def loss_runs(formatted: Column) -> Column:
    """Run lengths of the formatted text in code points: per turn how many to skip, how many hold its text
    (still escaped), and whether these are under the loss mask; after a text follow ``len(END) + 1`` more."""
    head = lambda p: F.regexp_extract(p, r"\A[^\n]*\n", 0)
    return F.transform(
        _pieces(formatted),
        lambda p: F.struct((F.lit(len(START)) + F.length(head(p))).alias("skip"), F.length(_body(p)).alias("take"), (head(p) == "assistant\n").alias("loss")),
    )
