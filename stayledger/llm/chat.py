"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is written as turns ``<|im_start|>role\\ntext<|im_end|>\\n``. The parser cuts at
these two control strings wherever they stand and takes one level of escapes off what lies
between. A turn is first written as it is and parsed again; where that does not give back the
turn, its content is escaped, which always does. So plain turns stay plain, and a text that holds
control strings, or what looks like an escape, is written with escapes.

A text is escaped by one more backslash in every ``<``, backslashes, ``|``; a role by percent
codes of ``%``, ``<`` and the line feed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, STOP = "<|im_start|>", "<|im_end|>"
_START, _STOP = r"<\|im_start\|>", r"<\|im_end\|>"
_ROLE_CODES = (("%", "%25"), ("<", "%3C"), ("\n", "%0A"))


def _escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return reduce(lambda c, code: F.replace(c, F.lit(code[0]), F.lit(code[1])), _ROLE_CODES, role)


def _unescape_role(role: Column) -> Column:
    return reduce(lambda c, code: F.replace(c, F.lit(code[1]), F.lit(code[0])), _ROLE_CODES[::-1], role)


def _written(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(STOP + "\n"))


def parsed(formatted: Column) -> Column:
    """The turns, as array<struct<role, text>>, of what ``format_chats`` has written; null for
    what the grammar does not allow."""
    heads = F.split(formatted, _START, -1)
    turns = F.transform(F.slice(heads, F.lit(2), F.greatest(F.size(heads) - 1, F.lit(0))),
                        lambda x: F.split(x, _STOP, -1))
    fine = (heads[0] == "") & F.forall(
        turns, lambda t: (F.size(t) == 2) & (F.try_element_at(t, F.lit(2)) == "\n") & F.contains(t[0], F.lit("\n")))
    return F.when(fine, F.transform(turns, lambda t: F.struct(
        _unescape_role(F.substring_index(t[0], "\n", 1)).alias("role"),
        _unescape(F.substr(t[0], F.instr(t[0], "\n") + 1)).alias("text"))))


def _same(formatted: Column, role: Column, text: Column) -> Column:
    return F.coalesce(parsed(formatted) == F.array(F.struct(role.alias("role"), text.alias("text"))), F.lit(False))


def format_chats(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", learn: str = "assistant") -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans, identical): a row for each conversation.

    ``loss_spans`` are the code points, start and stop, of the texts of role ``learn`` in
    ``formatted``; ``identical`` tells that parsing ``formatted`` gives the turns back. Turns go
    by number, then role, then text, null numbers first; null roles and texts count as empty;
    repeated rows are turns of their own; a null id is a conversation like any other; other
    columns play no part; no rows give no rows.
    """
    rows = turns.select(F.col(id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    role_, text_ = F.col("role"), F.col("text")
    # each part goes through the grammar alone, beside one that cannot conflict
    rows = rows.withColumns({
        "role_out": F.when(_same(_written(role_, F.lit("")), role_, F.lit("")), role_).otherwise(_escape_role(role_)),
        "text_out": F.when(_same(_written(F.lit(""), text_), F.lit(""), text_), text_).otherwise(_escape(text_))})
    rows = rows.withColumn("written", _written(F.col("role_out"), F.col("text_out")))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("written").cast("long")).over(before), F.lit(0)))
    head = F.length(F.lit(START)) + F.length("role_out") + 1
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "start", (F.col("start") + head).alias("low"), (F.col("start") + head + F.length("text_out")).alias("high"),
        "role", "text", "written"))).alias("turns"))
    formatted = grouped.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t.written), ""))
    return formatted.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), "formatted",
        F.transform(F.filter("turns", lambda t: t.role == learn), lambda t: F.struct(
            t.low.alias("start"), t.high.alias("stop"))).alias("loss_spans"),
        F.coalesce(parsed(F.col("formatted")) == F.transform("turns", lambda t: F.struct(t.role, t.text)),
                   F.lit(False)).alias("identical"))
