"""LM scoring with Brown class-based bigrams.

Tokens are lower-cased words and one end per text. Training tokens are counted by
Spark; a word travels as a 64-bit name whose low bits hold its suffix bucket. Words
with at least 1/``SHARE`` of the training tokens, so at most ``SHARE`` of them, are
sent to the tasks with their counts; the other words' counts are joined to the texts'
rare words by name. Those of them seen ``LEAST`` times, and the ``SEEDS`` most frequent
ones however rare, are clustered as words: they, the suffix buckets of all other words
and the end are the units of exchange clustering. Unit bigrams are counted over all
training texts by Spark, one row a unit. The most frequent words start the classes (a
dense exchange; other words count in their buckets); then each unit's (unit, class)
counts are taken in the tasks and it moves to the class that raises the class-bigram
likelihood most, a part of the units at a time, as long as the likelihood of all
training texts rises (at most ``ROUNDS`` times). A token has probability P(class | class before) * P(word | class), transitions smoothed
towards the class shares, emissions by adding one to every word of the class and to
one unseen word.

Defined cases: null text counts as empty: one token, the end; repeated rows each give
a row; a null id belongs to the training part; without training tokens every
probability is one of the smoothed uniform ones; an empty table gives an empty result.
Two words share a name with probability 2**-58. Only the id and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.arrays import array_rows, summed
from vaultline.llm.text import slices, texts_frame
from vaultline.session import materialize

SHARE = 2_000_000
LEAST = 10  # times a word is seen before its own bigrams say more than its bucket's
SEEDS, SUFFIX_BITS, CLASSES, SWEEPS, ROUNDS = 512, 6, 40, 20, 8
SUFFIXES = 1 << SUFFIX_BITS
END = b"\n"  # no word holds white space
PULL = 10.0  # weight of the class shares in a transition
_LOW = np.uint64(SUFFIXES - 1)
# Bytes of text tokenised at once.
AT_ONCE = 16 << 20
# Distinct words a task counts before it hands them on.
COUNTED = 400_000
# Distinct unit bigrams a task counts before it hands them on.
PAIRS = 1_000_000


def names_of(words: pa.StringArray) -> np.ndarray:
    """64-bit names of words, the suffix bucket (hashed from the last 3 bytes) in the low bits."""
    names = hash_array(words.to_numpy(zero_copy_only=False), categorize=False)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    last = np.zeros(len(words), np.uint32)
    for k in (1, 2, 3):
        has = np.diff(ends) >= k
        last[has] |= data[ends[1:][has] - k].astype(np.uint32) << np.uint32(8 * k - 8)
    bucket = (last * np.uint32(0x9E3779B1)) >> np.uint32(32 - SUFFIX_BITS)
    return names >> np.uint64(SUFFIX_BITS) << np.uint64(SUFFIX_BITS) | bucket.astype(np.uint64)


END_NAME = names_of(pa.array([END.decode()]))[0]


def _tokens(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the distinct tokens (the end last), the place of each token among them, and tokens per text.

    Lower case, the cuts at white space and the distinct words are Arrow's, so Python
    sees a word once a slice.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = lists.flatten().dictionary_encode()
    names, at = np.append(names_of(coded.dictionary), END_NAME), np.asarray(coded.indices).astype(np.int64)
    parts = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    empty = pc.index(coded.dictionary, "").as_py()  # what stands before a leading and after a trailing cut
    whole = at != empty
    n = np.diff(np.concatenate(([0], np.cumsum(whole)))[np.concatenate(([0], np.cumsum(parts)))])
    out = np.full(int(n.sum()) + len(n), len(names) - 1)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(n + 1) - 1] = False  # the end closes every text
    out[keep] = at[whole]
    return names, out, n + 1


def _each_slice(batches):
    """Rows with their tokens, ``AT_ONCE`` bytes of text at a time."""
    held, size = [], 0
    for batch in batches:
        for b in slices(batch, "t"):
            held.append(b)
            size += b.column("t").nbytes
            if size >= AT_ONCE:
                whole = pa.concat_batches(held)
                yield whole, *_tokens(whole.column("t"))
                held, size = [], 0
    if held:
        whole = pa.concat_batches(held)
        yield whole, *_tokens(whole.column("t"))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up."""
    keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)


def _counted(pairs, limit: int):
    """(keys, counts) of a task, merged, handed on when more than ``limit`` distinct keys are held."""
    parts, held = [], 0
    for keys, n in pairs:
        parts.append((keys, n))
        held += len(keys)
        if held > 2 * limit:
            parts = [_merged(parts)]
            held = len(parts[0][0])
            if held > limit:
                yield parts[0]
                parts, held = [], 0
    if parts:
        yield _merged(parts)


def count_words(train: DataFrame) -> DataFrame:
    """``(name, c)`` over all training texts ``(t)``."""
    def run(batches):
        counts = ((names, np.bincount(at, minlength=len(names))) for _, names, at, _ in _each_slice(batches))
        for names, n in _counted(counts, COUNTED):
            used = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(names[used].view(np.int64)), pa.array(n[used])], ["name", "c"])

    return train.mapInArrow(run, "name long, c long").groupBy("name").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """What every task needs: the frequent words, the classes of units, and log10 tables."""

    tokens: int
    words: int
    names: np.ndarray       # frequent words, sorted
    counts: np.ndarray
    units: np.ndarray       # of the frequent words
    buckets: np.ndarray     # of the words clustered by themselves, by unit
    classes: np.ndarray | None = None      # of units
    move: np.ndarray | None = None         # log10 P(class | class before)
    spread: np.ndarray | None = None       # log10 of the emission's denominator, by class

    @property
    def clustered(self) -> int:
        return len(self.buckets)

    @property
    def end(self) -> int:
        """The last unit; the suffix buckets come before it."""
        return self.clustered + SUFFIXES

    def look_up(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a token is frequent, its count there, and its unit."""
        unit = (names & _LOW).astype(np.int64) + self.clustered
        unit[names == END_NAME] = self.end
        if not len(self.names):
            return np.zeros(len(names), bool), np.zeros(len(names), np.int64), unit
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        known = self.names[at] == names
        unit[known] = self.units[at[known]]
        return known, np.where(known, self.counts[at], 0), unit


def frequent_words(vocabulary: DataFrame) -> Model:
    """Totals and the words above the share; at most ``SHARE`` rows by that definition."""
    tokens, words = vocabulary.agg(F.sum("c"), F.count("*")).first()
    tokens = tokens or 0
    top = vocabulary.where(F.col("c") * SHARE >= tokens).toPandas()
    names, counts = top["name"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    rank = np.lexsort((names, -counts))
    rank = rank[names[rank] != END_NAME]
    rank = rank[(np.arange(len(rank)) < SEEDS) | (counts[rank] >= LEAST)]
    buckets = (names & _LOW).astype(np.int64)
    units = buckets + len(rank)
    units[rank] = np.arange(len(rank))
    units[names == END_NAME] = len(rank) + SUFFIXES
    order = np.argsort(names)
    return Model(tokens, words, names[order], counts[order], units[order], buckets[rank])


def unit_bigrams(train: DataFrame, model: Model) -> DataFrame:
    """``(unit, near array<struct<key, n>>)``, one row a unit: the units after it, and
    those before it with the number of units added. A text begins after an end."""
    size = model.end + 1

    def run(batches):
        def pairs():
            for _, names, at, _ in _each_slice(batches):
                unit = model.look_up(names)[2][at]
                before = np.concatenate(([model.end], unit[:-1]))
                yield np.unique(before * size + unit, return_counts=True)

        for keys, n in _counted(pairs(), PAIRS):
            yield pa.RecordBatch.from_arrays([pa.array((keys // size).astype(np.int32)), pa.array((keys % size).astype(np.int32)),
                                              pa.array(n)], ["a", "b", "n"])

    pairs = train.mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    sides = pairs.select(F.expr(f"inline(array(named_struct('unit', a, 'key', b, 'n', n), "
                                f"named_struct('unit', b, 'key', a + {size}, 'n', n)))"))
    return sides.groupBy("unit").agg(F.collect_list(F.struct("key", "n")).alias("near"))


def _near(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, ...]:
    """Units, and of all their neighbours: row, whether before, unit and count."""
    units, lists = np.asarray(batch.column("unit")).astype(np.int64), batch.column("near")
    row = np.repeat(np.arange(len(units)), np.asarray(pa.compute.list_value_length(lists)))
    key, n = (np.asarray(x) for x in lists.flatten().flatten())
    before = key >= size
    return units, row, before, key - size * before, n


def class_table(bigrams: DataFrame, of: np.ndarray, classes: int) -> np.ndarray:
    """Counts [class before, class] of all unit bigrams."""
    def run(batches):
        total = np.zeros(classes * classes)
        for b in batches:
            units, row, before, other, n = _near(b, len(of))
            total += np.bincount((of[units[row]] * classes + of[other])[~before], n[~before], classes * classes)
        if total.any():
            yield array_rows(total.reshape(classes, classes))

    return summed(bigrams.mapInArrow(run, "part int, sums binary"), (classes, classes))


def bucket_words(vocabulary: DataFrame, model: Model) -> np.ndarray:
    """Distinct training words of each suffix bucket, and of the end."""
    def run(batches):
        total = np.zeros(SUFFIXES + 1)
        for b in batches:
            unit = model.look_up(np.asarray(b.column("name")).view(np.uint64))[2] - model.clustered
            total += np.bincount(unit[unit >= 0], minlength=SUFFIXES + 1)
        if total.any():
            yield array_rows(total.reshape(1, -1))

    return summed(vocabulary.select("name").mapInArrow(run, "part int, sums binary"), (1, SUFFIXES + 1))[0]


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """What of the log-likelihood depends on the classes."""
    return _h(table).sum() - _h(table.sum(0)).sum() - _h(table.sum(1)).sum()


def _best(table: np.ndarray, first: np.ndarray, second: np.ndarray, out: np.ndarray, into: np.ndarray, own: float, was: int) -> int:
    """The class for a unit that is taken out of ``table``, ``first`` and ``second`` (row and column sums)."""
    left, right, d = out.sum() + own, into.sum() + own, np.diagonal(table)
    # change of sum n(a, b) log n(a, b) - sum n(a) log n(a) - sum n(b) log n(b) for each class
    gain = (_h(table + out) - _h(table)).sum(1) + (_h(table + into[:, None]) - _h(table)).sum(0)
    gain += _h(d + out + into + own) + _h(d) - _h(d + out) - _h(d + into)
    gain -= _h(first + left) - _h(first) + _h(second + right) - _h(second)
    gain[0] = -np.inf
    best = int(gain.argmax())
    return was if gain[best] <= gain[was] + 1e-9 else best


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit by exchange clustering; the end (the last unit) keeps class 0 alone."""
    n = len(bigrams)
    left, right = bigrams.sum(1), bigrams.sum(0)
    order = np.argsort(-(left + right)[:-1], kind="stable")
    of = np.zeros(n, np.int64)
    of[order] = 1 + np.arange(n - 1) % (classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), of] = 1
    table = member.T @ bigrams @ member
    for _ in range(sweeps):
        moved = False
        for u in order[left[order] + right[order] > 0].tolist():
            was = of[u]
            member[u, was] = 0
            out, into, own = bigrams[u] @ member, bigrams[:, u] @ member, bigrams[u, u]
            table[was] -= out
            table[:, was] -= into
            table[was, was] -= own
            best = _best(table, left @ member, right @ member, out, into, own, was)
            moved |= best != was
            of[u] = best
            table[best] += out
            table[:, best] += into
            table[best, best] += own
            member[u, best] = 1
        if not moved:
            break
    return of


def proposed(bigrams: DataFrame, of: np.ndarray, table: np.ndarray, part: int, parts: int) -> list:
    """``(unit, class)`` of the units of one part that another class suits better."""
    first, second, classes = table.sum(1), table.sum(0), len(table)

    def run(batches):
        for b in batches:
            units, row, before, other, n = _near(b, len(of))
            itself = other == units[row]
            near = np.bincount((row * 2 + before) * classes + of[other], np.where(itself, 0, n), len(units) * 2 * classes)
            own = np.bincount(row, np.where(itself & ~before, n, 0), len(units))
            moves = []
            for u, (out, into), o in zip(units.tolist(), near.reshape(-1, 2, classes), own.tolist()):
                if u % parts != part or u == len(of) - 1:
                    continue
                was = of[u]
                t, f, s = table.copy(), first.copy(), second.copy()
                t[was] -= out
                t[:, was] -= into
                t[was, was] -= o
                f[was] -= out.sum() + o
                s[was] -= into.sum() + o
                best = _best(t, f, s, out, into, o, was)
                if best != was:
                    moves.append((u, best))
            yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in moves], pa.int32()) for k in (0, 1)], ["unit", "class"])

    return bigrams.mapInArrow(run, "unit int, class int").collect()  # at most the clustered units


def learn(train: DataFrame, vocabulary: DataFrame) -> Model:
    """Classes, transitions and emission denominators from all training texts."""
    model = frequent_words(vocabulary)
    bigrams = materialize(unit_bigrams(train, model), "lm_bigrams")
    seeds = min(SEEDS, model.clustered)
    seed = np.concatenate((np.arange(seeds), seeds + model.buckets[seeds:], seeds + np.arange(SUFFIXES + 1)))
    of = exchange(class_table(bigrams, seed, seeds + SUFFIXES + 1))[seed]
    table, parts, part = class_table(bigrams, of, CLASSES), 2, 0
    for _ in range(ROUNDS if model.clustered > seeds else 0):
        new = of.copy()
        for m in proposed(bigrams, of, table, part % parts, parts):
            new[m["unit"]] = m["class"]
        changed = class_table(bigrams, new, CLASSES)
        part += 1
        if likelihood(changed) > likelihood(table):
            of, table = new, changed
        else:  # moves that do not go together
            parts *= 2
    model.classes = of
    share = (table.sum(0) + 1) / (table.sum() + CLASSES)
    model.move = np.log10((table + PULL * share) / (table.sum(1, keepdims=True) + PULL))
    words = np.concatenate((np.ones(model.clustered), bucket_words(vocabulary, model)))
    model.spread = np.log10(table.sum(0) + np.bincount(of, words, CLASSES) + 1)
    return model


def _score_frequent(docs: DataFrame, model: Model) -> DataFrame:
    """Per row what needs no other count, and its rare words with their number of times."""
    def run(batches):
        for b, distinct, at, sizes in _each_slice(batches):
            ends, names = np.cumsum(sizes), distinct[at]
            known, count, unit = (x[at] for x in model.look_up(distinct))
            cls = model.classes[unit]
            before = np.concatenate(([model.classes[model.end]], cls[:-1]))
            shape = np.add.reduceat(model.move[before, cls] - model.spread[cls], ends - sizes)
            frequent = np.add.reduceat(np.where(known, np.log10(count + 1.0), 0), ends - sizes)
            n_known = np.add.reduceat(known.astype(np.int64), ends - sizes)
            rare = [np.unique(names[e - s:e][~known[e - s:e]], return_counts=True) for e, s in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays([
                b.column("id"), b.column("held_out"), pa.array(sizes), pa.array(n_known), pa.array(frequent), pa.array(shape),
                pa.array([r[0].view(np.int64) for r in rare], pa.list_(pa.int64())),
                pa.array([r[1] for r in rare], pa.list_(pa.int64()))],
                ["id", "held_out", "n_tokens", "n_known", "frequent", "shape", "rare", "times"])

    return docs.mapInArrow(run, "id long, held_out boolean, n_tokens long, n_known long, frequent double, shape double, "
                                "rare array<long>, times array<long>")


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    Learns from the rows whose ``held_out`` is not true. ``base_score`` is the add-one
    unigram log10 probability, ``score`` the class model's.
    """
    src = texts_frame(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                      F.col(text_col).cast("string").alias("t"))
    train = src.where("not held_out").select("t")
    vocabulary = materialize(count_words(train), "lm_words")
    model = learn(train, vocabulary)
    rows = materialize(_score_frequent(src, model).withColumn("key", F.monotonically_increasing_id()), "lm_rows")
    rare = rows.select("key", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "key", F.col("r.rare").alias("name"), F.col("r.times").alias("times"))
    others = vocabulary.where(F.col("c") * SHARE < model.tokens)
    found = (rare.join(others, "name").groupBy("key")
             .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more")))
    flat = float(np.log10(model.tokens + model.words + 1))
    counts = F.col("frequent") + F.coalesce("more", F.lit(0.0))
    return rows.drop("rare", "times").join(found, "key", "left").select(
        "id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (counts - F.col("n_tokens") * flat).alias("base_score"),
        (counts + F.col("shape")).alias("score"))


def perplexity(scored: DataFrame, by: str = "held_out") -> DataFrame:
    """Perplexity a token of the base and the class model, by group."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy(by).agg(per("base_score").alias("base_perplexity"), per("score").alias("perplexity"))
