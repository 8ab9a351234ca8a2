"""SimHash near-duplicates: bit-sliced comparison inside exact candidate buckets.

A fingerprint has 64 bits; bit i is set if it is set in over half of the XXH64
(seed 42) values of the text's word shingles. Fingerprints link at ``max_bits`` or
fewer differing bits. With ``max_bits + k`` blocks of bits, two linked fingerprints
agree in ``k`` blocks at least, so every ``k`` blocks are one bucket key and no link
is lost; ``k`` is 2 or more, as the number of fingerprints needs for small buckets
(more blocks are longer keys, and more of them). Buckets with more than ``BLOCK`` distinct fingerprints are cut into chunks
by hash and every pair of chunks meets in a bucket of its own. Inside a task a block
of fingerprints is stored as 64 bit planes; XOR with a query's bits and carry-save
counters update 64 distances per machine word, and rows all of whose distances
exceed the radius are given up. Only a spanning forest of a block's links leaves it.

Defined cases: null or empty text has fingerprint 0 and links like any other; fewer
words than a shingle are one shingle; repeated rows each get a row; links are between
fingerprints, so a row with a null id links like any other but never names a component,
and a component without an id has a null name; an empty table gives an empty result.
``near_duplicates`` reads the id and text columns only; ``one_of_each`` keeps all
columns, whatever they are called, and tells rows apart by a key of their own.
"""

from __future__ import annotations

import uuid
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.components import connected_components
from vaultline.llm.text import texts_frame, texts_of
from vaultline.session import materialize

# Distinct fingerprints compared in one block; a larger bucket is cut into chunks.
BLOCK = 512
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of one text (unsigned)."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())),
                         np.uint64, n)
    votes = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 15):
        part = hashes[k:k + (1 << 15)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, key: Column | None = None) -> DataFrame:
    """``(key, id, fp)`` per row; ``fp`` holds the unsigned fingerprint in a signed long, ``key`` is the caller's or null."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in texts_of(b, "_text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("_key"), b.column("_id"), pa.array(fps, pa.int64())], ["key", "id", "fp"])

    src = texts_frame(docs).select((F.lit(None) if key is None else key).cast("long").alias("_key"),
                                   F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return src.mapInArrow(run, "key long, id long, fp long")


def links_within(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Boolean matrix of pairs i < j at most ``max_bits`` apart (bit planes, carry-save counters)."""
    m = len(fps)
    width = -(-m // 64)
    bits = np.unpackbits(fps.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
    padded = np.zeros((64, width * 64), np.uint8)
    padded[:, :m] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
    queries = np.where(bits.T.astype(bool), _ALL, np.uint64(0))
    n_counters = max(1, max_bits.bit_length())
    later = np.zeros((m, width * 64), np.uint8)
    later[:, :m] = np.triu(np.ones((m, m), np.uint8), 1)
    over = ~np.packbits(later, axis=1, bitorder="little").view(np.uint64)  # lanes that no longer count
    rows = np.arange(m)
    counters = [np.zeros((m, width), np.uint64) for _ in range(n_counters)]
    for b in range(64):
        carry = planes[b][None, :] ^ queries[b][rows][:, None]
        for k in range(n_counters):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if b % 8 == 7:
            more, same = np.zeros_like(over), np.full_like(over, _ALL)
            for k in reversed(range(n_counters)):
                if max_bits >> k & 1:
                    same &= counters[k]
                else:
                    more |= same & counters[k]
                    same &= ~counters[k]
            over |= more
            alive = (over != _ALL).any(axis=1)
            if not alive.all():
                rows, over, counters = rows[alive], over[alive], [c[alive] for c in counters]
            if not len(rows):
                break
    out = np.zeros((m, m), bool)
    if len(rows):
        out[rows] = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, :m].astype(bool)
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """Smallest index of each row's component in a boolean link matrix."""
    m = len(linked)
    linked = linked | linked.T | np.eye(m, dtype=bool)
    label = np.arange(m)
    while True:
        new = np.where(linked, label[None, :], m).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(max_bits: int):
    def block(fp):
        linked = links_within(fp, max_bits)
        if not linked.any():
            return None
        label = forest(linked)
        child = np.flatnonzero(label != np.arange(len(label)))
        return fp[child].view(np.int64), fp[label[child]].view(np.int64)

    def emit(parts):
        parts = [p for p in parts if p is not None]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[k] for p in parts]), pa.int64())
                                              for k in (0, 1)], ["a", "b"])

    def groups(bucket, fp):
        """Blocks of whole buckets with two members at least."""
        cuts = np.flatnonzero((bucket[1:] != bucket[:-1]).any(axis=1)) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(bucket)]))
        big = ends - starts > 1
        starts, ends = starts[big], ends[big]
        if not len(starts):
            return
        keep = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends)])
        fp, sizes = fp[keep], ends - starts
        at, begun = 0, 0
        for size in sizes.tolist():
            if at > begun and at + size - begun > BLOCK:
                yield block(fp[begun:at])
                begun = at
            at += size
        yield block(fp[begun:at])

    def run(batches):
        held = None
        for b in batches:
            cols = [np.asarray(b.column(c)) for c in ("k", "x", "y", "fp")]
            bucket, fp = np.stack(cols[:3], axis=1), cols[3].view(np.uint64)
            if held is not None:
                bucket, fp = (np.concatenate(p) for p in zip(held, (bucket, fp)))
            last = np.flatnonzero((bucket != bucket[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = bucket[cut:], fp[cut:]
            if cut:
                yield from emit(groups(bucket[:cut], fp[:cut]))
        if held is not None and len(held[1]):
            yield from emit(groups(*held))

    return run


def _bucket_keys(max_bits: int, agree: int):
    """One long per ``agree`` of ``max_bits + agree`` blocks: their number above the blocks' bits."""
    n = max_bits + agree
    cuts = [64 * i // n for i in range(n + 1)]
    piece = lambda i: f"(shiftrightunsigned(fp, {cuts[i]}) & {(1 << cuts[i + 1] - cuts[i]) - 1}L)"
    out = []
    for t, blocks in enumerate(combinations(range(n), agree)):
        key = f"{t}L"
        if sum(cuts[i + 1] - cuts[i] for i in blocks) <= 50:
            for i in blocks:
                key = f"(shiftleft({key}, {cuts[i + 1] - cuts[i]}) | {piece(i)})"
        else:
            key = f"xxhash64({', '.join([key, *map(piece, blocks)])})"
        out.append(key)
    return F.expr(f"array({', '.join(out)})")


def _agreeing(n: int, max_bits: int) -> int:
    """Blocks a key needs for ``n`` fingerprints to give buckets of ``BLOCK`` on average."""
    return next((k for k in range(2, 12) if n >> (64 * k // (max_bits + k)) < BLOCK), 12)


def _groups(prints: DataFrame, max_bits: int, agree: int | None = None) -> DataFrame:
    """``(fp, root)`` of every fingerprint that links to another; the same root for all that links lead to."""
    texts = materialize(prints.select("fp").distinct(), "simhash_distinct")
    agree = agree or _agreeing(texts.count(), max_bits)
    keyed = texts.select("fp", F.explode(_bucket_keys(max_bits, agree)).alias("k"))
    hot = keyed.groupBy("k").count().where(F.col("count") > BLOCK)
    chunked = (keyed.join(hot, "k", "left")
               .withColumn("n", F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)).cast("int"))
               .withColumn("at", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
               .select("k", "fp", "at", F.explode(F.expr("sequence(0, n - 1)")).alias("other"))
               .select("k", F.least("at", "other").alias("x"), F.greatest("at", "other").alias("y"), "fp"))
    pairs = (chunked.repartition("k", "x", "y").sortWithinPartitions("k", "x", "y")
             .mapInArrow(_compare(max_bits), "a long, b long"))
    roots = connected_components(pairs, "simhash_links").select(F.col("node").alias("fp"), "root")
    return materialize(roots, "simhash_roots")  # a stored side lets Spark split a join on a fingerprint that many rows share


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, agree: int | None = None) -> DataFrame:
    """``(id, fp, component)`` per row; ``component`` is the smallest id that links lead to.

    ``agree`` sets the blocks of a bucket key (2 or more); by default the number of fingerprints does.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, shingle).select("id", "fp"), "simhash_fp")
    ids = prints.groupBy("fp").agg(F.min("id").alias("least"))
    linked = materialize(_groups(prints, max_bits, agree).join(ids, "fp"), "simhash_linked")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    named = ids.join(linked.join(least, "root").select("fp", "component"), "fp", "left")
    named = materialize(named.select("fp", F.coalesce("component", "least").alias("component")), "simhash_named")
    return prints.join(named, "fp", "left").select("id", "fp", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                max_bits: int = 4) -> DataFrame:
    """One row of ``docs``, all columns, of every component: the one with the smallest id, a null id last.

    Rows are told apart by a key of their own, not by their ids: different texts under
    one id both stay, and of rows that share id and text one stays. Texts move only
    where the rows to drop exceed Spark's broadcast threshold.
    """
    row = f"_row_{uuid.uuid4().hex}"
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "simhash_rows")
    prints = materialize(fingerprints(keyed, id_col, text_col, shingle, F.col(row)), "simhash_fp")
    grouped = prints.join(_groups(prints, max_bits), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    grouped = materialize(grouped, "simhash_grouped")
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("f")).select(F.col("f.key").alias("key"))
    dropped = materialize(grouped.join(first, "key", "left_anti").select(F.col("key").alias(row)), "simhash_dropped")
    return keyed.join(dropped, row, "left_anti").drop(row)
