"""Chat formatting with DataFrame functions only.

A record is a VARIANT of any layout. ``schema_of_variant`` spells its nested field
paths; that text without leaf types is hashed, and the fingerprint selects one of the
declarative mappings in ``LAYOUTS``, a SQL expression giving canonical turns
``array<struct<role, text>>``. Turns of a conversation are put in order and written as

    <|im_start|>role<|im_sep|>text<|im_end|>

one after another. Control strings inside roles and texts get one more backslash
after their first character, which ``unescape`` takes away again. Loss spans (start
and length in code points of the formatted text) cover each assistant text once.

Defined cases: a null or missing role or text is empty; turns order by turn number,
place in the record, role, text, so ties are stable, and repeated rows are repeated
turns; rows with a null conversation id form one conversation; a record whose layout
is not declared gives no turn (``layout`` is null in ``canonical_turns``), and a
conversation without turns gives an empty format; an empty table gives no row. Only
the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of this template and of other common chat templates.
CONTROLS = (START, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """Field paths (types left out) and the SQL expression over ``rec`` that yields turns."""

    name: str
    shape: str
    turns: str


def _get(path: str, kind: str = "string") -> str:
    return f"try_variant_get(rec, '$.{path}', '{kind}')"


def _pair(user: str, assistant: str, before: str = "") -> str:
    return f"array({before}struct('user' as role, {user} as text), struct('assistant' as role, {assistant} as text))"


def _list(path: str, role: str, text: str) -> str:
    return f"transform({_get(path, f'array<struct<{role}: string, {text}: string>>')}, m -> struct({{0}} as role, m.{text} as text))"


_FROM = "case m.`from` when 'human' then 'user' when 'gpt' then 'assistant' else m.`from` end"
_SHAREGPT = f"transform({_get('conversations', 'array<struct<`from`: string, value: string>>')}, m -> struct({_FROM} as role, m.value as text))"
_SYSTEM = f"struct('system' as role, {_get('system')} as text), "

LAYOUTS = (
    Layout("turn", "OBJECT<role: , text: >", f"array(struct({_get('role')} as role, {_get('text')} as text))"),
    Layout("content", "OBJECT<content: , role: >", f"array(struct({_get('role')} as role, {_get('content')} as text))"),
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content: , role: >>>", _list("messages", "role", "content").format("m.role")),
    Layout("turns", "OBJECT<turns: ARRAY<OBJECT<role: , text: >>>", _list("turns", "role", "text").format("m.role")),
    Layout("conversations", "OBJECT<conversations: ARRAY<OBJECT<from: , value: >>>", _SHAREGPT),
    Layout("system conversations", "OBJECT<conversations: ARRAY<OBJECT<from: , value: >>, system: >",
           f"concat(array({_SYSTEM[:-2]}), {_SHAREGPT})"),
    Layout("completion", "OBJECT<completion: , prompt: >", _pair(_get("prompt"), _get("completion"))),
    Layout("response", "OBJECT<prompt: , response: >", _pair(_get("prompt"), _get("response"))),
    Layout("system response", "OBJECT<prompt: , response: , system: >", _pair(_get("prompt"), _get("response"), _SYSTEM)),
    Layout("instruction", "OBJECT<instruction: , output: >", _pair(_get("instruction"), _get("output"))),
    Layout("instruction input", "OBJECT<input: , instruction: , output: >",
           _pair(f"concat_ws('\\n\\n', {_get('instruction')}, nullif({_get('input')}, ''))", _get("output"))),
)


def field_paths(rec: str = "rec") -> Column:
    """Nested field names of a variant, leaf types left out, keys in sorted order."""
    return F.regexp_replace(F.expr(f"schema_of_variant({rec})"),
                            r"(?<=: |<|^)(?!OBJECT|ARRAY)[A-Z_]+(\(\d+,\s?\d+\))?(?=,|>|$)", "")


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``(conv_id, turn, rec VARIANT)`` -> ``(conv_id, turn, layout, pos, role, text)``.

    A record of an undeclared layout, or without turns, keeps one row with null ``pos``.
    """
    known = records.select("conv_id", "turn", "rec", F.xxhash64(field_paths()).alias("fp"))
    name, turns = "case", "case"
    for lay in layouts:
        name += f" when fp = xxhash64('{lay.shape}') then '{lay.name}'"
        turns += f" when fp = xxhash64('{lay.shape}') then cast({lay.turns} as {_TURNS})"
    return (known.select("conv_id", "turn", F.expr(f"{name} end").alias("layout"),
                         F.posexplode_outer(F.expr(f"{turns} end")).alias("pos", "m"))
            .select("conv_id", "turn", "layout", "pos", F.coalesce("m.role", F.lit("")).alias("role"),
                    F.coalesce("m.text", F.lit("")).alias("text")))


def _control_pattern(escaped: bool) -> str:
    firsts = "".join(sorted({re.escape(c[0]) for c in CONTROLS}))
    rests = "|".join(re.escape(c[1:]) for c in sorted(CONTROLS))
    return rf"([{firsts}])(\\*)" + (r"\\" if escaped else "") + f"({rests})"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _control_pattern(False), r"$1$2\\$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _control_pattern(True), "$1$2$3")


def format_chats(turns: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans array<struct<start, n>>)`` from canonical turns."""
    order = ["turn", "pos", "role", "text"]
    said = turns.select("conv_id", *order, escape(F.col("role")).alias("r"), escape(F.col("text")).alias("t"))
    # a null pos is a record without turns: it keeps its conversation but adds nothing
    piece = F.when(F.col("pos").isNotNull(), F.concat(F.lit(START), "r", F.lit(SEP), "t", F.lit(END))).otherwise("")
    said = said.withColumn("piece", piece)
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    said = said.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0))
                           + F.length("r") + len(START) + len(SEP))
    mark = F.struct("start", F.length("t").cast("long").alias("n"))
    span = F.when(F.col("pos").isNotNull() & (F.col("role") == "assistant"), mark)
    listed = F.array_sort(F.collect_list(F.struct(*order, "piece", span.alias("span"))))
    return (said.groupBy("conv_id").agg(listed.alias("all"))
            .select("conv_id", F.concat_ws("", "all.piece").alias("formatted"),
                    F.filter("all.span", lambda s: s.isNotNull()).alias("loss_spans")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text parsed from the formatted text: ``(conv_id, turns, loss_text)``."""
    piece = F.filter(F.split("formatted", re.escape(END)), lambda p: p != "")
    turns = F.transform(piece, lambda p: F.struct(
        unescape(F.split(F.substr(p, F.lit(len(START) + 1)), re.escape(SEP), 2)[0]).alias("role"),
        unescape(F.split(p, re.escape(SEP), 2)[1]).alias("text")))
    masked = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"].cast("int") + 1,
                                                                  s["n"].cast("int"))))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.concat_ws("", masked).alias("loss_text"))
