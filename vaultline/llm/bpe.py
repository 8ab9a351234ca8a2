"""Byte-level BPE with word ends, encoded by contiguous rank arrays.

A word is a row of parts with the merge ranks of adjacent parts beside it. The
smallest rank (the leftmost of equals) is looked for, its boundary is deleted by
moving the rest of the row up, and the two neighbouring ranks are refreshed, until
no pair has a rank. All new words of a slice advance together, in one numpy array per
width, and a worker remembers words within a fixed size. Words over ``WIDE`` bytes
take a heap of ranks over linked parts instead, so a word of any length is bounded.

Text rules of the vocabulary file: its two special strings are found first, in the
raw text; the rest is NFC, lower-cased code point by code point, split into
contractions, letter runs, single numbers and other runs, white space dropped.

Defined cases: null text counts as empty (no ids); repeated rows each give a row; an
empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.text import slices, texts_frame

WIDE = 64
MEMO_WORDS = 200_000
NO_RANK = np.int32(2**31 - 1)
# Fixed value: how the vocabulary's definition splits normalized text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Characters Python's split() takes for white space and the vocabulary's rules do not.
_NOT_SPACE = regex.compile(r"[\x1c-\x1f]")
_WORDS = regex.compile(r"[^\t-\r \x85\xa0  -     　]+")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Merge tables of one vocabulary file and the words encoded so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.last = np.array([vocab[c + end] for c in chars], np.int32)
        pairs = [(a, b) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"] for a, b in [m]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        self.rank_of = dict(zip(keys.tolist(), range(len(pairs))))
        self.memo: dict[str, bytes] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of adjacent parts; ``NO_RANK`` where there is no merge."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NO_RANK)

    def _merge_rows(self, parts: np.ndarray, size: np.ndarray) -> list[bytes]:
        """Token ids (as bytes) of words given as rows of parts (padded with -1)."""
        n, width = parts.shape
        done, done_size = np.empty((n, width), "<u4"), np.empty(n, np.int64)
        rows = np.arange(n)
        place = np.arange(width)
        ranks = np.full((n, width), NO_RANK, np.int32)
        if width > 1:
            ranks[:, :-1] = np.where(parts[:, 1:] >= 0, self.ranks(parts[:, :-1], parts[:, 1:]), NO_RANK)
        while True:
            at = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            least = ranks[line, at]
            ended = least == NO_RANK
            done[rows[ended]], done_size[rows[ended]] = parts[ended], size[ended]
            live = ~ended
            if not live.any():
                flat, step = done.tobytes(), 4 * width
                return [flat[k * step:k * step + 4 * m] for k, m in enumerate(done_size.tolist())]
            rows, at, least, size = rows[live], at[live], least[live], size[live] - 1
            parts, ranks = parts[live], ranks[live]
            line = np.arange(len(rows))
            source = np.minimum(place[None, :] + (place[None, :] > at[:, None]), width - 1)
            parts, ranks = np.take_along_axis(parts, source, 1), np.take_along_axis(ranks, source, 1)
            parts[line, at] = self.merged[least]
            ended_row = size < width
            parts[line[ended_row], size[ended_row]] = -1
            after = np.minimum(at + 1, width - 1)
            right = parts[line, after]
            ranks[line, at] = np.where((right >= 0) & (after > at), self.ranks(parts[line, at], right), NO_RANK)
            left = at > 0
            ranks[line[left], at[left] - 1] = self.ranks(parts[line[left], at[left] - 1], parts[line[left], at[left]])

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges for one long word: smallest rank, leftmost first."""
        nxt, prev = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1)
                if (r := self.rank_of.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        end = len(ids)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= end or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[r]), -1
            nxt[i] = nxt[j]
            if nxt[i] < end:
                prev[nxt[i]] = i
            for k in (prev[i], i):
                if k >= 0 and nxt[k] < end and (q := self.rank_of.get(ids[k] << 32 | ids[nxt[k]])) is not None:
                    heapq.heappush(heap, (q, k, ids[k], ids[nxt[k]]))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids, as bytes, of distinct pieces (UTF-8 bytes of normalized text)."""
        out: list = [None] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for width in (4, 8, 12, 16, 24, 32, WIDE):
            lower = {4: 0, 8: 4, 12: 8, 16: 12, 24: 16, 32: 24, WIDE: 32}[width]
            chosen = np.flatnonzero((sizes > lower) & (sizes <= width))
            for k in range(0, len(chosen), 20_000):
                part = chosen[k:k + 20_000]
                size = sizes[part]
                buf = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in part.tolist()), np.uint8)
                raw = buf.reshape(len(part), width)
                ids = self.inner[raw]
                ids[np.arange(len(part)), size - 1] = self.last[raw[np.arange(len(part)), size - 1]]
                ids[np.arange(width)[None, :] >= size[:, None]] = -1
                for i, got in zip(part.tolist(), self._merge_rows(ids, size)):
                    out[i] = got
        for i in np.flatnonzero(sizes > WIDE).tolist():
            raw = np.frombuffer(pieces[i], np.uint8)
            out[i] = np.array(self._merge_long([*self.inner[raw[:-1]].tolist(), int(self.last[raw[-1]])]), "<u4").tobytes()
        return out

    def learn(self, words: set[str]) -> None:
        """Encode words that are not remembered yet."""
        if len(self.memo) + len(words) > MEMO_WORDS:
            self.memo.clear()
        new = [w for w in words if w not in self.memo]
        split = [[n] if n.isalpha() else PIECES.findall(n) for n in map(normalize, new)]
        pieces = list({p for ps in split for p in ps})
        coded = dict(zip(pieces, self.encode_pieces([p.encode() for p in pieces])))
        for w, ps in zip(new, split):
            self.memo[w] = coded[ps[0]] if len(ps) == 1 else b"".join([coded[p] for p in ps])

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Token ids as little-endian unsigned 32-bit integers, per text."""
        split = [self._segments(t) for t in texts]
        self.learn({w for ws in split for w in ws if type(w) is str})
        get = self.memo.__getitem__
        return [b"".join([get(w) if type(w) is str else w for w in ws]) if "<|" in t else b"".join(map(get, ws))
                for t, ws in zip(texts, split)]

    def _segments(self, text: str) -> list:
        """Words of a text; a special string becomes its id, as bytes."""
        parts = self.special_re.split(text) if self.special_re and "<|" in text else [text]
        out: list = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                out += _WORDS.findall(part) if _NOT_SPACE.search(part) else part.split()
        return out

    def decode(self, ids: bytes) -> str:
        """Text of an id sequence: the tokens, joined by one space (the file names no decoder)."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def normalize(word: str) -> str:
    """NFC, then each code point in lower case without regard to its place in the word."""
    return word.lower() if word.isascii() else unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``(id, ids binary)`` per row; ids as little-endian unsigned 32-bit integers.

    With ``decoded`` the text decoded from the ids is one more column, made in the same
    Python step, so a core needs one worker and one vocabulary.
    """
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for b in slices(batch, "t"):
                got = vocab.encode_texts([t or "" for t in b.column("t").to_pylist()])
                columns = [b.column("id"), pa.array(got, pa.binary())]
                if decoded:
                    columns.append(pa.array([vocab.decode(ids) for ids in got], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "decoded"][:len(columns)])

    src = texts_frame(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return src.mapInArrow(run, "id long, ids binary" + ", decoded string" * decoded)


def decode(coded: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the decoded text of ``ids_col`` in one more column; null ids give an empty text."""
    def run(batches):
        vocab = vocabulary(path)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                texts = [vocab.decode(x or b"") for x in part.column(ids_col).to_pylist()]
                yield part.append_column(into, pa.array(texts, pa.string()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(run, f"{fields}, `{into}` string")
