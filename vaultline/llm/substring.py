"""Substring dedup: words of windows that a document with a smaller id holds too.

A window is ``window`` consecutive words. Recompression names the words' structure:
runs of one word become one symbol, then in each round every adjacent pair (left
class, right class) becomes one symbol, the class being a bit of the symbol's name.
Names are hashes of what they stand for, so all tasks agree on them, and the context
that decides a symbol (the words it covers and those next to it that could have
changed it) is tracked exactly. Two neighbouring symbols whose context fits into a
window form a key: any window over that context brings the same key with it wherever
it occurs.

Round one gathers the keys of every chunk of documents, once per chunk, and learns
which ones more than one document holds; a window over a key of one document only
cannot be repeated and is dropped. Round two verifies the windows that are left by
96 bits of hash over their words, again once per chunk with the smallest id that holds
them, and learns where a smaller id exists in another chunk. Answers return as one bit
a key or window, so nothing grows with the number of occurrences and a passage that a
third of all documents share is one row a chunk. Texts are shuffled once, into a table
bucketed by chunk that the three passes read without moving it again.

Defined cases: null text has no words; a text shorter than a window loses nothing;
rows repeated under one id are one document and do not remove each other's words; a
row with a null id loses nothing and takes nothing away; an empty table gives an empty
result. Only the id and text columns are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.text import Names, mix, slices, texts_frame, texts_of
from vaultline.session import materialize, work_dir

WINDOW = 13
ROUNDS = 2
# Text of a chunk, and of the chunks whose keys one bucket holds, on average.
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 32 << 20
_FAR = 1 << 40  # a context that leaves the document fits into no window
_LOW32 = np.uint64(0xFFFFFFFF)


def recompress(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS):
    """Symbols after ``rounds``: name, first and end word of the deciding context, document."""
    n = len(names)
    head = np.ones(n, bool)
    head[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, n))
    sym, doc = names[at], doc[at]
    run = length > 1
    sym[run] = mix(sym[run], length[run].astype(np.uint64))
    lo, hi = at - 1, at + length + 1  # the neighbours show that the run ends here
    if n:
        first = np.append(True, doc[1:] != doc[:-1])
        lo[first] -= _FAR
        hi[np.append(first[1:], True)] += _FAR
    for r in range(rounds):
        left = (mix(sym, r + 1) >> np.uint64(40) & np.uint64(1)).astype(bool)
        same = doc[1:] == doc[:-1]
        pair = np.append(left[:-1] & ~left[1:] & same, False)[:len(sym)]
        second = np.append(False, pair[:-1])[:len(sym)]
        alone = ~pair & ~second
        new_lo, new_hi = lo.copy(), hi.copy()
        # a lone symbol depends on the neighbour it might have paired with
        ahead, behind = np.flatnonzero(alone & left), np.flatnonzero(alone & ~left)
        inside = ahead[np.append(same, False)[ahead]]
        new_hi[ahead] += _FAR
        new_hi[inside] = np.maximum(hi[inside], hi[inside + 1])
        inside = behind[np.append(False, same)[behind]]
        new_lo[behind] -= _FAR
        new_lo[inside] = np.minimum(lo[inside], lo[inside - 1])
        i = np.flatnonzero(pair)
        new = sym.copy()
        new[i] = mix(sym[i], sym[i + 1])
        new_lo[i], new_hi[i] = np.minimum(lo[i], lo[i + 1]), np.maximum(hi[i], hi[i + 1])
        keep = ~second
        sym, lo, hi, doc = new[keep], new_lo[keep], new_hi[keep], doc[keep]
    return sym, lo, hi, doc


def keys_of(names: np.ndarray, doc: np.ndarray, window: int):
    """Keys of neighbouring symbols whose joint context fits into a window: key, first, end, document."""
    sym, lo, hi, doc = recompress(names, doc)
    key = mix(sym[:-1], sym[1:])
    lo, hi = np.minimum(lo[:-1], lo[1:]), np.maximum(hi[:-1], hi[1:])
    fits = (doc[:-1] == doc[1:]) & (hi - lo <= window) if len(key) else np.zeros(0, bool)
    return key[fits], lo[fits], hi[fits], doc[:-1][fits]


def window_hashes(names: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and an independent 32-bit check of the window starting at each word."""
    n = max(0, len(names) - window + 1)
    h, check = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        other = names ^ (names >> np.uint64(31))
        for j in range(window):
            h = h * np.uint64(0x9E3779B97F4A7C15) + names[j:j + n]
            check = check * np.uint64(0xD6E8FEB86659FD93) + other[j:j + n]
    return mix(h, 1), mix(check, 2) & _LOW32


class _Chunk:
    """Names, documents and id ranks of a chunk's words (rows without an id have no words here)."""

    def __init__(self, batches, window: int):
        memo, names, sizes, ids = Names(), [], [], []
        for batch in batches:
            for b in slices(batch, "t"):
                own = b.column("id").to_pylist()
                split = [t.split() if i is not None else [] for i, t in zip(own, texts_of(b, "t"))]
                sizes += map(len, split)
                ids += [0 if i is None else i for i in own]
                names.append(memo.of([w for ws in split for w in ws]))
        self.window = window
        self.sizes = np.array(sizes, np.int64)
        self.ids, rank = np.unique(np.array(ids, np.int64), return_inverse=True)
        self.names = np.concatenate(names) if names else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        self.rank = rank  # of each row's id among the chunk's ids

    def keys(self, buckets: int):
        """Sorted distinct keys (bucket above 32 bits), which of several documents, each place's key and context."""
        key, lo, hi, doc = keys_of(self.names, self.doc, self.window)
        key = ((key >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (key & _LOW32)
        order = np.argsort(key, kind="stable")
        new = np.append(True, key[order][1:] != key[order][:-1])[:len(key)]
        starts, place = np.flatnonzero(new), np.empty(len(key), np.int64)
        place[order] = np.cumsum(new) - 1
        rank = self.rank[doc][order]
        many = np.minimum.reduceat(rank, starts) != np.maximum.reduceat(rank, starts) if len(starts) else np.zeros(0, bool)
        return key[order][starts], many, place, lo, hi

    def candidates(self, buckets: int, shared: np.ndarray, keys) -> np.ndarray:
        """Starts of the windows all of whose keys are shared."""
        _, _, place, lo, hi = keys
        n, w = len(self.names), self.window
        if n < w:
            return np.zeros(0, np.int64)
        single = ~shared[place]
        step = np.bincount(np.maximum(hi[single] - w, 0), minlength=n + 2) - np.bincount(lo[single] + 1, minlength=n + 2)
        dead = np.cumsum(step)[:n - w + 1] > 0
        return np.flatnonzero(~dead & (self.doc[:n - w + 1] == self.doc[w - 1:]))

    def windows(self, at: np.ndarray, buckets: int):
        """Distinct windows by (bucket, hash, check), the least id rank of each, and each start's window."""
        h, check = window_hashes(self.names, self.window)
        h, check = h[at], check[at]
        bucket = (check * np.uint64(2654435761) + h) % np.uint64(buckets)
        order = np.lexsort((check, h, bucket))
        h, check, bucket = h[order], check[order], bucket[order]
        new = np.append(True, (h[1:] != h[:-1]) | (check[1:] != check[:-1]))[:len(h)]
        starts, place = np.flatnonzero(new), np.empty(len(h), np.int64)
        place[order] = np.cumsum(new) - 1
        rank = self.rank[self.doc[at]]
        least = np.minimum.reduceat(rank[order], starts) if len(starts) else np.zeros(0, np.int64)
        return bucket[starts].astype(np.int64), h[starts], check[starts], least, place, rank


def _cut(bucket: np.ndarray):
    """(bucket, from, to) of each run of a sorted bucket column."""
    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
    return zip(bucket[edges].tolist(), edges.tolist(), np.append(edges[1:], len(bucket)).tolist())


def _answered(answers: pa.Table, kind: int, bucket: np.ndarray) -> np.ndarray:
    """One bit per sorted key or window, put together from the answers of all buckets."""
    out = np.zeros(len(bucket), bool)
    if len(bucket):
        rows = {b: v for k, b, v in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "bits"))) if k == kind}
        for b, s, e in _cut(bucket):
            out[s:e] = np.unpackbits(np.frombuffer(rows[b], np.uint8), count=e - s).astype(bool)
    return out


_ANSWER = "kind int, chunk int, bucket int, bits binary"


def _answer_row(kind: int, chunk: int, bucket: int, bits: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([chunk], pa.int32()), pa.array([bucket], pa.int32()),
                                       pa.array([np.packbits(bits).tobytes()], pa.binary())], ["kind", "chunk", "bucket", "bits"])


def _send_keys(window: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, many, *_ = _Chunk(batches, window).keys(buckets)
        rows = [(b, (keys[s:e] & _LOW32).astype(np.uint32).tobytes(), np.packbits(many[s:e]).tobytes())
                for b, s, e in _cut((keys >> np.uint64(32)).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([key[0].as_py()] * len(rows), pa.int32()),
             pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
            ["bucket", "chunk", "keys", "many"])

    return run


def _shared_keys(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk's keys of a bucket: does more than one document hold them?"""
    rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("chunk", "keys", "many")))]
    held = [np.frombuffer(k, np.uint32) for _, k, _ in rows]
    distinct, times = np.unique(np.concatenate(held), return_counts=True)
    for (chunk, _, many), k in zip(rows, held):
        bits = np.unpackbits(np.frombuffer(many, np.uint8), count=len(k)).astype(bool)
        yield _answer_row(0, chunk, key[0].as_py(), bits | (times[np.searchsorted(distinct, k)] > 1))


def _send_windows(window: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(docs.to_batches(), window)
        keys = chunk.keys(buckets)
        shared = _answered(answers, 0, (keys[0] >> np.uint64(32)).astype(np.int64))
        bucket, h, check, least, _, _ = chunk.windows(chunk.candidates(buckets, shared, keys), buckets)
        ids = chunk.ids[least] if len(least) else np.zeros(0, np.int64)
        base = int(ids.min()) if len(ids) else 0
        kind = np.uint32 if len(ids) and int(ids.max()) - base < 1 << 32 else np.uint64
        offset = (ids.astype(np.uint64) - np.uint64(base % (1 << 64))).astype(kind)
        rows = [(b, h[s:e].tobytes(), check[s:e].astype(np.uint32).tobytes(), offset[s:e].tobytes()) for b, s, e in _cut(bucket)]
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         pa.array([base] * len(rows), pa.int64()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))],
                        names=["bucket", "chunk", "base", "hashes", "checks", "offsets"])

    return run


def _earlier_windows(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk's windows of a bucket: does another chunk hold them under a smaller id?"""
    chunks, hashes, checks, ids = [], [], [], []
    for b in batches:
        for chunk, base, h, c, o in zip(*(b.column(x).to_pylist() for x in ("chunk", "base", "hashes", "checks", "offsets"))):
            chunks.append(chunk)
            hashes.append(np.frombuffer(h, np.uint64))
            checks.append(np.frombuffer(c, np.uint32))
            offset = np.frombuffer(o, np.uint32 if len(o) == len(c) else np.uint64).astype(np.uint64)
            ids.append((offset + np.uint64(base % (1 << 64))).view(np.int64))
    h, c, own = np.concatenate(hashes), np.concatenate(checks), np.concatenate(ids)
    order = np.lexsort((own, c, h))
    new = np.append(True, (np.diff(h[order]) != 0) | (np.diff(c[order]) != 0))
    least = np.empty_like(own)
    least[order] = own[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier, at = least < own, 0
    for chunk, part in zip(chunks, hashes):
        yield _answer_row(1, chunk, key[0].as_py(), earlier[at:at + len(part)])
        at += len(part)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed", _SPANS), ("kept", pa.string())])


def _strike(window: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        batches = docs.to_batches()
        chunk = _Chunk(batches, window)
        keys = chunk.keys(buckets)
        at = chunk.candidates(buckets, _answered(answers, 0, (keys[0] >> np.uint64(32)).astype(np.int64)), keys)
        bucket, _, _, least, place, rank = chunk.windows(at, buckets)
        gone = at[(rank > least[place]) | _answered(answers, 1, bucket)[place]] if len(at) else at
        n = len(chunk.names)
        cover = np.cumsum(np.bincount(gone, minlength=n + window + 1) - np.bincount(gone + window, minlength=n + window + 1))[:n] > 0
        first = np.cumsum(chunk.sizes) - chunk.sizes
        out, row = [], 0
        for b in batches:
            for i, t in zip(b.column("id").to_pylist(), texts_of(b, "t")):
                words = t.split()
                mask = cover[first[row]:first[row] + chunk.sizes[row]]
                row += 1
                spans = []
                if mask.any():
                    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
                    spans = [{"start": s, "end": e} for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
                kept, done = [], 0
                for s in spans:
                    kept += words[done:s["start"]]
                    done = s["end"]
                out.append((i, len(words), int(mask.sum()), spans, b" ".join(kept + words[done:])))
        return pa.table([pa.array([o[k] for o in out], pa.binary()).cast(pa.string()) if k == 4 else
                         pa.array([o[k] for o in out], _RESULT.field(k).type) for k in range(5)], schema=_RESULT)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(id, n_words, n_removed, removed array<struct<start, end>>, kept)`` per row.

    ``removed`` are word ranges, ``kept`` the other words joined by one space. The
    result reads a work table in the shared folder (``substring_docs_*`` in the
    session's catalog), which may be dropped once the result is stored.
    """
    spark = docs.sparkSession
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)
    src = texts_frame(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    size = src.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    chunks, buckets = max(2 * n, size // CHUNK_BYTES), max(n, size // BUCKET_BYTES)
    name = f"substring_docs_{uuid.uuid4().hex}"
    (src.withColumn("chunk", F.pmod(F.xxhash64("id", "t"), F.lit(chunks)).cast("int"))
     .repartition(n, "chunk").write.bucketBy(n, "chunk").format("parquet").option("compression", "zstd")
     .option("path", work_dir(spark, "substring_docs")).saveAsTable(name))
    texts = spark.table(name).groupBy("chunk")
    keys = texts.applyInArrow(_send_keys(window, buckets), "bucket int, chunk int, keys binary, many binary")
    shared = materialize(keys.groupBy("bucket").applyInArrow(_shared_keys, _ANSWER), "substring_keys")
    found = texts.cogroup(shared.groupBy("chunk")).applyInArrow(
        _send_windows(window, buckets), "bucket int, chunk int, base long, hashes binary, checks binary, offsets binary")
    earlier = materialize(found.groupBy("bucket").applyInArrow(_earlier_windows, _ANSWER), "substring_windows")
    return texts.cogroup(shared.unionByName(earlier).groupBy("chunk")).applyInArrow(
        _strike(window, buckets), "id long, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept string")
