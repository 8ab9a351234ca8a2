"""Benchmark decontamination by greedy string tiling.

Tokens are lower-cased runs outside ASCII white space and punctuation. Karp-Rabin
hashes of every ``MIN_MATCH`` tokens of a document are looked up among those of the
benchmark items; seeds on one diagonal join into maximal matches, which are compared
token by token. The longest match that is still free on both sides is marked, again
and again, down to ``MIN_MATCH`` tokens, so passages are found in any order. A
document leaks an item when the marked tiles cover ``MIN_COVERAGE`` of its tokens.

A benchmark of at most ``MAX_SENT_BYTES`` (counted first) goes to the tasks whole and
documents are read once. Beyond that bound, seed hashes of both sides are joined, and
only the documents and items that share a seed are brought together.

Defined cases: null or empty texts leak nothing; an item of fewer than ``MIN_MATCH``
tokens, or with a null id, cannot be tested and matches nothing; item rows repeated
under one id count once, by their best coverage; repeated document rows each give
rows; an empty table on either side gives an empty result. Only the id and text
columns are read; ``clean`` returns all columns. Rows are judged one by one on both
sides of the bound (beyond it each carries a key of its own), also without a unique id.
"""

from __future__ import annotations

import heapq
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.text import Names, slices, texts_frame, texts_of
from vaultline.session import materialize

MIN_MATCH, MIN_COVERAGE = 5, 0.5
MAX_SENT_BYTES = 32 << 20
_FOLD = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in bytes(range(256)).lower())
_BASE = 0x9E3779B97F4A7C15
_FILTER_BITS = 22


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def seed_hashes(names: np.ndarray, k: int = MIN_MATCH) -> np.ndarray:
    """Karp-Rabin hash of every k consecutive names."""
    n = max(0, len(names) - k + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * np.uint64(_BASE) + names[j:j + n]
        return out ^ (out >> np.uint64(31))


def tile(doc: list[bytes], item: list[bytes], at_doc: np.ndarray, at_item: np.ndarray, k: int = MIN_MATCH) -> list[tuple]:
    """Greedy tiles (item start, doc start, length) from seed places; longest first, then leftmost."""
    order = np.lexsort((at_item, at_doc - at_item))
    d, i = at_doc[order], at_item[order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(d - i) != 0) | (np.diff(i) != 1))))
    runs = np.diff(np.concatenate((new, [len(d)])))
    heap = [(-(n + k - 1), a, b) for n, a, b in zip(runs.tolist(), i[new].tolist(), d[new].tolist())
            if doc[b:b + n + k - 1] == item[a:a + n + k - 1]]
    heapq.heapify(heap)
    used_item, used_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    tiles = []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = ~(used_item[a:a + n] | used_doc[b:b + n])
        if free.all():
            used_item[a:a + n] = used_doc[b:b + n] = True
            tiles.append((a, b, n))
            continue
        edge = np.diff(np.concatenate(([0], free.view(np.int8), [0])))
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if e - s >= k:
                heapq.heappush(heap, (s - e, a + s, b + s))
    return tiles


class Items:
    """Benchmark items with a sorted seed index, built once per worker."""

    def __init__(self, rows: list[tuple[int, bytes]], k: int):
        memo = Names()
        self.k = k
        self.ids = [r[0] for r in rows]
        self.tokens = [tokens(r[1]) for r in rows]
        seeds = [seed_hashes(memo.of(t), k) for t in self.tokens]
        self.hash = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        sizes = np.array([len(s) for s in seeds], np.int64)
        self.item = np.repeat(np.arange(len(seeds)), sizes)
        self.place = np.concatenate([np.arange(n) for n in sizes]) if seeds else np.zeros(0, np.int64)
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.item, self.place = self.hash[order], self.item[order], self.place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.hash >> np.uint64(64 - _FILTER_BITS)] = True

    def leaks(self, doc: list[bytes], hashes: np.ndarray, least: float) -> list[tuple]:
        """(item id, coverage, tiles, matched tokens) of the items that one text leaks."""
        maybe = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _FILTER_BITS)])
        if not len(maybe):
            return []
        first = np.searchsorted(self.hash, hashes[maybe], "left")
        n = np.searchsorted(self.hash, hashes[maybe], "right") - first
        if not n.any():
            return []
        at_doc = np.repeat(maybe, n)
        seed = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        items, at_item = self.item[seed], self.place[seed]
        best: dict = {}
        for it in np.unique(items).tolist():
            mine = items == it
            length = len(self.tokens[it])
            # tiles cover no more than the places under some seed
            if len(np.unique((at_item[mine][:, None] + np.arange(self.k)).ravel())) < least * length:
                continue
            tiles = tile(doc, self.tokens[it], at_doc[mine], at_item[mine], self.k)
            matched = sum(t[2] for t in tiles)
            if matched >= least * length and matched:
                found = (matched / length, len(tiles), matched)
                best[self.ids[it]] = max(found, best.get(self.ids[it], found))
        return [(i, *v) for i, v in sorted(best.items())]


def _leaks_of(batch: pa.RecordBatch, text_col: str, items: Items, memo: Names, least: float) -> list[list[tuple]]:
    out = []
    for t in texts_of(batch, text_col):
        doc = tokens(t)
        out.append(items.leaks(doc, seed_hashes(memo.of(doc), items.k), least) if len(doc) >= items.k else [])
    return out


def _small(benchmark: DataFrame) -> bool:
    return (benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) <= MAX_SENT_BYTES


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")).dropna()


_SCHEMA = "id long, item_id long, coverage double, n_tiles long, n_matched long"


def _rows(ids: list, leaks: list[list[tuple]]) -> pa.RecordBatch:
    flat = [(d, *x) for d, xs in zip(ids, leaks) for x in xs]
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in flat], kind) for k, kind in enumerate(kinds)],
                                      ["id", "item_id", "coverage", "n_tiles", "n_matched"])


def _sent(rows: list, k: int):
    """The items, indexed on first use in a worker."""
    held: list[Items] = []

    def items() -> Items:
        if not held:
            held.append(Items(rows, k))
        return held[0]

    return items


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH,
               min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``(id, item_id, coverage, n_tiles, n_matched)`` for each document and item it leaks."""
    items = _items(benchmark, item_col, item_text)
    src = texts_frame(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    if not _small(items):
        keyed = materialize(src.withColumn("key", F.monotonically_increasing_id()), "leaks_docs")
        found = _find_joined(keyed.select("key", "t"), items, min_match, min_coverage)
        return found.join(keyed.select("key", "id"), "key").select("id", "item_id", "coverage", "n_tiles", "n_matched")
    get = _sent([(r.item, r.text.encode()) for r in items.orderBy("item", "text").collect()], min_match)

    def run(batches):
        memo = Names()
        for batch in batches:
            for b in slices(batch, "t"):
                yield _rows(b.column("id").to_pylist(), _leaks_of(b, "t", get(), memo, min_coverage))

    return src.mapInArrow(run, _SCHEMA)


def _find_joined(keyed: DataFrame, items: DataFrame, k: int, least: float) -> DataFrame:
    """The same rows by a join of seed hashes, ``key`` for id, from stored rows ``(key, t)``."""
    def seeds(batches):
        memo = Names()
        for batch in batches:
            for b in slices(batch, "t"):
                hashes = [np.unique(seed_hashes(memo.of(tokens(t)), k)) for t in texts_of(b, "t")]
                key = np.repeat(np.asarray(b.column("key")), [len(h) for h in hashes])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.concatenate(hashes).view(np.int64))], ["key", "h"])

    def compare(batches):
        memo = Names()
        for b in batches:
            keys, out = b.column("key").to_pylist(), []
            for item, text, doc in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), b.column("t").to_pylist()):
                words = tokens(doc.encode())
                out.append(Items([(item, text.encode())], k).leaks(words, seed_hashes(memo.of(words), k), least))
            yield _rows(keys, out)

    keyed = keyed.where("t is not null")
    texts = materialize(items.withColumn("key", F.monotonically_increasing_id()), "leaks_items")
    ours = keyed.select("key", "t").mapInArrow(seeds, "key long, h long")
    theirs = texts.select("key", F.col("text").alias("t")).mapInArrow(seeds, "key long, h long").withColumnRenamed("key", "item_key")
    pairs = ours.join(theirs, "h").select("key", "item_key").distinct()
    both = pairs.join(texts.withColumnRenamed("key", "item_key"), "item_key").join(keyed, "key")
    found = both.select("key", "item", "text", "t").mapInArrow(compare, _SCHEMA).withColumnRenamed("id", "key")
    return found.groupBy("key", "item_id").agg(F.max(F.struct("coverage", "n_tiles", "n_matched")).alias("m")).select(
        "key", "item_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH,
          min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """The rows of ``docs``, all columns, that leak no item."""
    items = _items(benchmark, item_col, item_text)
    if not _small(items):
        row = f"_row_{uuid.uuid4().hex}"
        keyed = materialize(texts_frame(docs).withColumn(row, F.monotonically_increasing_id()), "leaks_rows")
        src = keyed.select(F.col(row).alias("key"), F.col(text_col).cast("string").alias("t"))
        bad = _find_joined(src, items, min_match, min_coverage).select(F.col("key").alias(row)).distinct()
        return keyed.join(bad, row, "left_anti").select(docs.columns)
    get = _sent([(r.item, r.text.encode()) for r in items.orderBy("item", "text").collect()], min_match)

    def run(batches):
        memo = Names()
        for batch in batches:
            for b in slices(batch, text_col):
                keep = [not x for x in _leaks_of(b, text_col, get(), memo, min_coverage)]
                yield b.filter(pa.array(keep, pa.bool_()))

    return texts_frame(docs).mapInArrow(run, docs.schema)
