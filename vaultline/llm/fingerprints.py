"""Document fingerprints by locally consistent parsing.

Words are the first symbols. In each round runs of one symbol become one symbol, then
deterministic coin tossing (twice the lowest bit in which a symbol differs from the
one before it, plus that bit; three times over) gives every symbol a label below 8
that differs from its neighbours'. A phrase starts where the label is a local minimum
and is named by a hash of its symbols, and the phrases are the next round's symbols.
Where a phrase starts depends on a few neighbours only, so equal substrings share
their interior phrases at any offset. The fingerprint keeps, for each of ``BINS``
bins, 16 bits of the least phrase name of all rounds that falls into the bin; the
likeness of two fingerprints is the share of used bins that agree, an estimate of the
Jaccard similarity of the phrase sets.

Each document is also compared with the next one in descending id order (after the
last: the first). Ids are cut into ranges by their quantiles, texts are moved once to
their range, and the first document of a range is copied to the range before it, so
neighbours meet without a global sort in one task.

Defined cases: null text counts as empty; a text without words has no phrase, and two
such fingerprints are equal (likeness 1), while one against another text has likeness
0; rows repeated under one id follow each other in the order of their texts' hashes;
null ids come after all others; a table of one row is its own next document; an empty
table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.text import SLICE_BYTES, Names, int_range, mix, texts_frame

BINS = 64
ROUNDS = 8
_ONE = np.uint64(1)


def _collapse_runs(sym: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A run of one symbol inside a document becomes one symbol named by its length."""
    head = np.ones(len(sym), bool)
    head[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, len(sym)))
    out = sym[at]
    run = length > 1
    out[run] = mix(out[run], length[run].astype(np.uint64))
    return out, doc[at]


def _labels(sym: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Deterministic coin tossing, three times: labels below 8, different from their neighbours'."""
    first = np.ones(len(sym), bool)
    first[1:] = doc[1:] != doc[:-1]
    x = sym
    for _ in range(3):
        d = np.empty_like(x)
        d[1:] = x[1:] ^ x[:-1]
        d[first] = _ONE
        d = np.where(d == 0, _ONE, d)
        low = np.bitwise_count((d & (~d + _ONE)) - _ONE).astype(np.uint64)
        x = (low << _ONE) | (x >> low & _ONE)
    return x


def parse(sym: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round: phrase names, their documents, and the first symbol of each (after runs)."""
    sym, doc = _collapse_runs(sym, doc)
    label = _labels(sym, doc)
    start = np.ones(len(sym), bool)
    start[1:] = doc[1:] != doc[:-1]
    same_left = ~start
    same_right = np.append(same_left[1:], False)
    start[1:-1] |= (label[1:-1] < label[:-2]) & (label[1:-1] < label[2:]) & same_left[1:-1] & same_right[1:-1]
    at = np.flatnonzero(start)
    size = np.diff(np.append(at, len(sym)))
    with np.errstate(over="ignore"):
        total = np.add.reduceat(mix(sym, int_range(size).astype(np.uint64)), at)
    return mix(total, size.astype(np.uint64)), doc[at], at


def fingerprint_texts(texts: list[bytes], memo: Names) -> np.ndarray:
    """(texts, BINS) array of 16-bit values; 0 is an empty bin."""
    split = [t.split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    sym = np.concatenate([memo.of(w) for w in split]) if len(split) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    names, docs = [], []
    for level in range(ROUNDS):
        if not len(sym):
            break
        sym, doc, _ = parse(sym, doc)
        names.append(sym)
        docs.append(doc)
        count = np.bincount(doc, minlength=len(texts))
        more = count[doc] > 1  # a single phrase is the top of its text
        sym, doc = sym[more], doc[more]
    out = np.zeros((len(texts), BINS), np.uint16)
    if names:
        name, where = np.concatenate(names), np.concatenate(docs)
        cell = where * BINS + (name % np.uint64(BINS)).astype(np.int64)
        order = np.lexsort((name, cell))
        cell, name = cell[order], name[order]
        least = np.ones(len(cell), bool)
        least[1:] = cell[1:] != cell[:-1]
        kept = (name[least] >> np.uint64(40) & np.uint64(0xFFFF)).astype(np.uint16)
        out.reshape(-1)[cell[least]] = np.maximum(kept, 1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of used bins that agree, row by row; 1 where no bin is used on either side."""
    used = ((a != 0) | (b != 0)).sum(1)
    return np.where(used == 0, 1.0, ((a == b) & (a != 0)).sum(1) / np.maximum(used, 1))


def _hex(rows: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() for r in rows]


def edited(text: str, following: str) -> str:
    """The last half of a text (rounded down) replaced by the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_SCHEMA = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def _compare(rows: list[tuple], memo: Names) -> pa.RecordBatch:
    """Rows (id, text) in order; the last one is only the following document of the one before it."""
    texts = [r[1] for r in rows]
    changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:])]
    prints = fingerprint_texts([t.encode() for t in texts], memo)
    new = fingerprint_texts(changed, memo)
    own = prints[:-1]
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows[:-1]], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in changed]), pa.array(_hex(own)), pa.array(_hex(new)),
        pa.array(likeness(own, new)), pa.array(likeness(own, prints[1:]))], _NAMES)


def _walk(batches):
    """Rows sorted by (range, copied, id descending): each with the one after it in its range."""
    memo, held, size, range_now = Names(), [], 0, None
    for b in batches:
        for r, copied, i, t in zip(*(b.column(c).to_pylist() for c in ("range", "copied", "id", "t"))):
            if r != range_now:
                held, size, range_now = [], 0, r
            if copied and (not held or held[-1][2]):
                continue  # rows of the copied id beyond the first
            held.append((i, t or "", copied))
            size += len(held[-1][1])
            if len(held) > 1 and (copied or size > SLICE_BYTES):
                yield _compare(held, memo)
                held, size = held[-1:], 0


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness (see ``_SCHEMA``)."""
    spark = docs.sparkSession
    src = texts_frame(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    order = F.coalesce("id", F.lit(-(1 << 63)))
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = src.agg(F.percentile_approx(order, [k / n for k in range(1, n)], 100 * n)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, key.to_numpy(np.int64), "left"), dtype="int32")

    # the first id of each range that has rows; at most one row a range
    heads = src.select(range_of(order).alias("r"), order.alias("key")).groupBy("r").agg(F.max("key").alias("key")).orderBy("r").collect()
    keys = np.array([h.key for h in heads], np.int64)[::-1]
    before = np.roll(np.array([h.r for h in heads], np.int32), 1)[::-1]

    @F.pandas_udf("int")
    def copied_to(key: pd.Series) -> pd.Series:
        k = key.to_numpy(np.int64)
        at = np.minimum(np.searchsorted(keys, k), max(0, len(keys) - 1))
        return pd.Series(np.where(keys[at] == k, before[at], -1), dtype="int32") if len(keys) else pd.Series(np.full(len(k), -1), dtype="int32")

    placed = src.select("id", "t", F.explode(F.filter(
        F.array(F.struct(range_of(order).alias("range"), F.lit(False).alias("copied")),
                F.struct(copied_to(order).alias("range"), F.lit(True).alias("copied"))),
        lambda s: s["range"] >= 0)).alias("s")).select("s.*", "id", "t")
    return (placed.repartitionById(n, F.col("range") % n)  # one range a partition
            .sortWithinPartitions("range", "copied", F.desc_nulls_last("id"), F.xxhash64("t"))
            .mapInArrow(_walk, _SCHEMA))
