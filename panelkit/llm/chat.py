"""Chat formatting with a grammar round trip.

Template: ``[INST] text [/INST]`` for a user, ``<<SYS>> text <</SYS>>`` for a system
message, ``<s> text </s>`` for an assistant and ``<role name> text </role>`` for any other
role. The parser reads an opening mark, one space, the shortest text that is followed by
one space and a closing mark, and undoes the escapes ``&lb; &lt; &gt; &amp;``.

A conversation is rendered as it is and parsed again. If the turns that come back are
not the turns that went in, the texts that fail alone are escaped; if that is not
enough, all are. An escaped text holds no ``[`` or ``<`` and so no mark, hence the last
try always comes back identical.

Defined results: turns are ordered by turn (NULL first), then role, then text, so ties and
repeated rows have one order. NULL text and NULL role are empty; rows with NULL conv_id
form one conversation. An empty table gives no rows; further columns are ignored. A
conversation becomes one string, as its digest needs it, so it must fit in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import let

OPEN = "(\\[INST\\]|<<SYS>>|<s>|<role [^>]*>)"
CLOSE = "(\\[/INST\\]|<</SYS>>|</s>|</role>)"
TURN = f"(?s){OPEN} (.*?) {CLOSE}"


def escape(text: Column) -> Column:
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lb;")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in (("[", "&lb;"), (">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def by_role(role: Column, user: Column, system: Column, assistant: Column, other: Column) -> Column:
    return (
        F.when(role == "user", user).when(role == "system", system).when(role == "assistant", assistant).otherwise(other)
    )


def opening(role: Column) -> Column:
    name = F.concat(F.lit("<role "), escape(role), F.lit(">"))
    return by_role(role, F.lit("[INST]"), F.lit("<<SYS>>"), F.lit("<s>"), name)


def closing(role: Column) -> Column:
    return by_role(role, F.lit("[/INST]"), F.lit("<</SYS>>"), F.lit("</s>"), F.lit("</role>"))


def render_turn(turn: Column) -> Column:
    """``turn`` has a role and a written text, which is escaped or not."""
    return F.concat(opening(turn["role"]), F.lit(" "), turn["text"], F.lit(" "), closing(turn["role"]))


def parse(rendered: Column) -> Column:
    """Turns (role, text) of a rendered conversation."""

    def turn(piece: Column) -> Column:
        mark = F.regexp_extract(piece, TURN, 1)
        name = unescape(F.regexp_extract(mark, "<role ([^>]*)>", 1))
        role = (
            F.when(mark == "[INST]", "user").when(mark == "<<SYS>>", "system").when(mark == "<s>", "assistant").otherwise(name)
        )
        return F.struct(role.alias("role"), unescape(F.regexp_extract(piece, TURN, 2)).alias("text"))

    return F.transform(F.regexp_extract_all(rendered, F.lit(TURN), F.lit(0)), turn)


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render_turn), "")


def comes_back(rendered: Column, turns: Column) -> Column:
    """Whether parsing gives the turns and nothing is left over."""
    rest = F.length(F.regexp_replace(rendered, TURN, ""))
    return (parse(rendered) == turns) & (rest == 0)


def written(turns: Column, everything: bool) -> Column:
    """The turns with escaped texts: all, or those that do not come back alone."""

    def one(turn: Column) -> Column:
        text = escape(turn["text"])
        if not everything:
            text = F.when(comes_back(render_turn(turn), F.array(turn)), turn["text"]).otherwise(text)
        return F.struct(turn["role"].alias("role"), text.alias("text"))

    return F.transform(turns, one)


def chosen(turns: Column) -> Column:
    """The first way of writing that comes back identical."""
    some, every = written(turns, False), written(turns, True)
    return (
        F.when(comes_back(render(turns), turns), turns)
        .when(let(some, lambda w: comes_back(render(w), turns)), some)
        .otherwise(every)
    )


def mask(turns: Column) -> Column:
    """Code point ranges of the assistant texts in the rendered string."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(opening(turn["role"])) + 1
        end = begin + F.length(turn["text"])
        here = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], here)).otherwise(state["spans"])
        return F.struct((state["at"] + F.length(render_turn(turn))).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans."""
    empty = F.lit("")
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    ordered = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    turns = rows.groupBy("conv_id").agg(ordered.alias("turns"))
    ready = turns.select("conv_id", let(F.col("turns"), chosen).alias("written"))
    return ready.select("conv_id", render(F.col("written")).alias("formatted"), mask(F.col("written")).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text of the output, read from the rendered string alone."""
    loss = F.transform(
        "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
    )
    return formatted.select(
        "conv_id", "formatted", parse(F.col("formatted")).alias("turns"), F.array_join(loss, "").alias("loss_text")
    )


def digests(back: DataFrame) -> DataFrame:
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
