"""Quality rules with DataFrame functions only: rules on a text, and line frequency across documents.

Rules on a text count words (runs outside space and U+0009..U+000D), their code points,
symbols, repeated lines and words inside 5-word windows that the text has twice or more.
A text fails with fewer than ``MIN_WORDS`` words, or if repeated windows cover more than
``MAX_REPEATED`` percent of them.

Line frequency: lines are normalised (words joined by one space, A-Z in lower case,
digits as 0) and hashed; each host counts in how many of its documents a line occurs.
Lines above both limits of their host (``LINE_DOCUMENTS`` documents, ``LINE_SHARE`` of
the host's documents) are removed; a text is depleted and rejected when fewer than
``MIN_WORDS`` words or ``MIN_LEFT`` of its words are left.

Texts are read once, inside the JVM, and never shuffled: the windows of a text are
compared in its own row (hashed, and sorted only where a hash occurs twice). Line
counts are combined before their shuffle, so a line that every document has is one row
a task; the frequent lines are stored, and Spark sends them to the tasks or joins them
by host and line as their size tells.

Defined cases: a null text is empty: no words, and it fails; a null host is a host of
its own; a document is a row, so rows repeated under one id, null ids included, are
judged one by one and count once each; a line repeated in a document counts once; an
empty table has no row. Hashes have 64 bits: two different lines of a host, or two
windows of a text, that share one would count as equal. Columns are read by name;
``clean`` keeps all columns, whatever they are called.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.session import materialize

MIN_WORDS, MAX_REPEATED, WINDOW = 10, 20, 5
#: A line goes if more documents of a host have it than this number and this share of the host's documents.
LINE_DOCUMENTS, LINE_SHARE = 10, 0.1
#: Share of a text's words that must be left when frequent lines are gone.
MIN_LEFT = 0.3
SYMBOLS = "#*$%&|<>"
_BLANK = r"[\\x20\\x09-\\x0D]+"
_FROM, _TO = string.ascii_uppercase + string.digits, string.ascii_lowercase + "0" * 10


def _hash(words: str) -> str:
    return f"xxhash64(translate(array_join({words}, ' '), '{_FROM}', '{_TO}'))"


def _measured(docs: DataFrame, key: Column, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Per row: key, id, host, the counts of the text, and its lines as (hash, words)."""
    t = docs.select(key.alias("key"), F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    t = t.withColumn("lines", F.split("t", "\n"))
    t = t.withColumn("said", F.expr(f"transform(lines, l -> array_remove(split(l, '{_BLANK}'), ''))"))
    t = t.withColumn("words", F.flatten("said")).withColumn("full", F.expr("filter(lines, (l, i) -> size(said[i]) > 0)"))
    items = ", ".join(f"words[i + {k}]" for k in range(WINDOW))
    t = t.withColumn("windows", F.expr(f"case when size(words) >= {WINDOW} then transform(sequence(0, size(words) - {WINDOW}), "
                                       f"i -> xxhash64({items})) else array() end"))
    # only texts with a window twice are sorted
    t = t.withColumn("placed", F.expr("case when size(array_distinct(windows)) < size(windows) then "
                                      "sort_array(transform(windows, (h, i) -> struct(h as h, i as i))) end"))
    twice = "(k > 0 and placed[k - 1].h = x.h) or (k < size(placed) - 1 and placed[k + 1].h = x.h)"
    t = t.withColumn("starts", F.expr(f"sort_array(transform(filter(placed, (x, k) -> {twice}), x -> x.i))"))
    covered = f"aggregate(transform(starts, (s, k) -> least({WINDOW}, coalesce(get(starts, k + 1), s + {WINDOW}) - s)), 0L, (a, x) -> a + x)"
    return t.select(
        "key", "id", "host", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.expr(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.expr(f"transform(filter(said, w -> size(w) > 0), w -> struct({_hash('w')} as h, size(w) as n))").alias("lines"))


def _frequent(measured: DataFrame) -> DataFrame:
    """(host, h): lines above both limits of their host."""
    lines = measured.select("host", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    counted = lines.groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > LINE_DOCUMENTS)
    hosts = materialize(measured.groupBy("host").agg(F.count(F.lit(1)).alias("all")), "rules_hosts")
    above = counted.join(hosts, counted["host"].eqNullSafe(hosts["host"])).where(F.col("docs") > LINE_SHARE * F.col("all"))
    return materialize(above.select(counted["host"], "h"), "rules_frequent")


def _judged(measured: DataFrame) -> DataFrame:
    """``measured`` without its lines, with the lines removed, what is left, and the verdicts."""
    frequent = _frequent(measured)
    lines = measured.select("key", "host", F.explode("lines").alias("l")).select("key", "host", "l.h", "l.n")
    hit = lines.join(frequent, lines["host"].eqNullSafe(frequent["host"]) & (lines["h"] == frequent["h"]), "left_semi")
    gone = hit.groupBy("key").agg(F.sum("n").alias("n_removed"), F.collect_set("h").alias("removed"))
    out = measured.drop("lines").join(gone, "key", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed")
    depleted = (left < MIN_WORDS) | (left < MIN_LEFT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed, base_failed, kept``, one row a document."""
    measured = materialize(_measured(docs, F.monotonically_increasing_id(), id_col, text_col, host_col), "rules_measured")
    return _judged(measured).drop("key", "host", "removed")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that are kept, all columns, their texts without the lines removed.

    The rows are stored once under a key of their own, so neither ids nor column names need be unique to them.
    """
    row = f"_row_{uuid.uuid4().hex}"
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rules_documents")
    measured = materialize(_measured(keyed, F.col(row), id_col, text_col, host_col), "rules_measured")
    verdict = _judged(measured).where("kept").select(F.col("key").alias(row), F.col("removed").alias(f"{row}_h"))
    text = F.col(text_col).cast("string")
    h = _hash(f"array_remove(split(l, '{_BLANK}'), '')")
    left = F.expr(f"array_join(filter(split(cast(`{text_col}` as string), '\\n'), l -> not array_contains({row}_h, {h})), '\\n')")
    return (keyed.join(verdict, row).withColumn(text_col, F.when(F.col(f"{row}_h").isNull(), text).otherwise(left))
            .select(*docs.columns))
