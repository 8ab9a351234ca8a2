"""Secret scans: base rules plus character Markov models compared by log-likelihood ratio.

Base kinds are exact rules (``assign``, ``access``, ``hex``). The method adds kind
``markov``: runs of 20 or more characters of ``[A-Za-z0-9+/_=-]`` that touch no base
span and that the first-order model of random strings explains better than the model
of ordinary identifiers by ``MIN_RATIO`` nats and ``MIN_MEAN`` nats a character.
A run is judged by its parts between ``+/_=-``: separators count for neither model, a
number or the digits that end a part neither (up to 19). A part of letters only that
splits at its capitals into words of 2 to ``MAX_WORD`` letters, on average ``MEAN_WORD``
if there are several, is also read as those words in lower case by an ordinary model
that is mixed with one of ``IDENTIFIER_WORDS``; the more ordinary reading counts. A run
is found when all its parts together pass the bounds or one part of 20 or more characters does.
Both models are transition tables trained from labelled samples: given ones
(``sample_counts``) or those the base rules label in the corpus itself
(``corpus_counts``: what a base rule finds is random, every other run of under 20
characters is ordinary, longer ones are undecided and train neither model).
Counts cover all rows and are summed by Spark; at most 2 x 66 x 65 of them reach the
driver. The random model is mixed with a uniform one, so that alphabets without a
sample are known too.

Defined cases: null text counts as empty and has no span; offsets are code points of
the whole text, end exclusive; repeated rows each give a row; without any sample both
models are uniform and nothing is added; an empty table gives an empty result. Only
the id and text columns are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.text import texts_frame

KINDS = ("assign", "access", "hex", "markov")
# The base rules (keywords and minimum lengths).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
N = len(ALPHABET)
MIN_RUN, MIN_RATIO, MIN_MEAN = 20, 12.0, 0.5
# Letters of a camel-case or capital word: at most, and on average in a part of several words at least.
MAX_WORD, MEAN_WORD = 15, 3.5
_CODE = np.full(256, -1, np.int16)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(N)
REPLACEMENT = "[SECRET]"
# A labelled sample of the words that identifiers and paths are made of.
IDENTIFIER_WORDS = """about access account action active adapter address admin after agent alert align alpha amount android angle
api app apache append application apply archive area argument array article asset async attribute audio auth author available
average back background balance bank bar base batch begin between bill binary bind bit black block blog blue board body book
boolean border bottom bound box branch bridge broker browser bucket budget build bundle business button byte cache calendar call
camera cancel capacity card case cast category cell center chain change channel char chart check child city class clean clear
click client clock clone close cloud cluster code codec collection color column command comment commit common company compare
complete component compute config connect console constant contact container content context control convert copy core count
country create credit cross current cursor custom customer daily dark data database date day debug decode default delay delete
delta demo deploy depth description design detail device dialog direct disable disk display docs document domain double down
download draft driver drop dump duration dynamic edge edit editor element email empty enable encode end engine entity entry enum
error event example exception execute exist expire export express extension external extra factory failure false family feature
fetch field figure file filter final find first fix flag float flow focus folder font footer force foreign form format forward
found frame free from front full function game gateway general generate get global grand graph green grid group guide hand handler
hash head header heap height hello help hidden high history home hook host hour html http icon identifier image import include
index info init inner input insert install instance integer interface internal invalid invoice item iterator java javascript job
join journal jump json keep kernel key kind label lambda language large last layer layout left length level library license light
limit line link linux list listener load local lock log login logo long loop main make manager map mark market master match
material matrix maximum measure media member memory menu merge message meta method metric middle minimum mobile mode model module
money month mount mouse move multiple music name native network never new next node normal note notify null number object offset
old online open operation option order origin other output owner package page panel paper parent parse part partner password path
pattern pause payment people percent person phone photo picture pixel place plan platform play plugin point policy pool popup
port position post power prefix present price primary print priority private process product profile program project property
protocol provider proxy public publish pull push python quality quantity query queue quick quote random range rate raw reader ready
record red reference region register release remote remove render report request reset resource response result return review
right role root route row rule run sample save scale schedule schema scope screen script scroll search second section security
select sender sequence series server service session setting setup shape share sheet shell short show side sign signal simple
single site size skip slice small social sort sound source space spark special speed split sql square stack staff stage standard
star start state static status step stock stop storage store stream street string strong structure style subject submit success
sum summary super support switch symbol sync syntax system tab table tag target task team template temp term test text theme
thread ticket time title toggle token tool top total trace track traffic transaction transfer transform tree trigger true type
under unique unit unknown update upload upper user util valid value variable vector vendor verify version vertical video view
virtual visible visit volume wait wallet warning watch weather web week weight white widget width window word work worker world
wrapper write xml year yellow zero zip zone""".split()


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of alphabet characters."""
    inside = np.concatenate(([0], (codes >= 0).view(np.int8), [0]))
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def base_spans(text: bytes, starts=None, ends=None) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the value) in bytes, base rules only.

    The rules are ASCII, so they are applied to UTF-8 bytes; texts without ``:``,
    ``=``, ``AKIA`` or a long run skip the rule that needs one.
    """
    found = []
    if b":" in text or b"=" in text:
        found += [(m.start(), m.end(), "assign", m.start(2)) for m in _ASSIGN_B.finditer(text)
                  if m.end(2) - m.start(2) >= LEAST["assign"]]
    if b"AKIA" in text:
        found += [(m.start(), m.end(), "access", m.start()) for m in _ACCESS_B.finditer(text)
                  if m.end() - m.start() >= LEAST["access"]]
    if starts is None:
        starts, ends = _runs(_CODE[np.frombuffer(text, np.uint8)])
    long = ends - starts >= LEAST["hex"]
    for a, b in zip(starts[long].tolist(), ends[long].tolist()):
        found += [(a + m.start(), a + m.end(), "hex", a + m.start()) for m in _HEX_B.finditer(text[a:b])
                  if m.end() - m.start() >= LEAST["hex"]]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


_ASSIGN_B = re.compile(ASSIGN.pattern.encode(), re.I)
_ACCESS_B, _HEX_B = (re.compile(p.pattern.encode()) for p in (ACCESS, HEX))


def _transitions(codes: np.ndarray) -> np.ndarray:
    """Counts [previous or start, next] over the runs of a code array."""
    before = np.concatenate((np.array([-1], np.int16), codes[:-1]))
    here = codes >= 0
    rows = np.where(before[here] < 0, N, before[here]).astype(np.int64)
    return np.bincount(rows * N + codes[here], minlength=(N + 1) * N)


def _count_rows(totals: np.ndarray):
    label, cell = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(cell.astype(np.int32)),
                                      pa.array(totals[label, cell])], ["label", "cell", "n"])


def corpus_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(label, cell, n)``: transition counts of all texts; label 1 is what the base rules find."""
    def run(batches):
        totals = np.zeros((2, (N + 1) * N), np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                codes = _CODE[np.frombuffer(t, np.uint8)]
                starts, ends = _runs(codes)
                spans = base_spans(t, starts, ends)
                for s in spans:
                    totals[1] += _transitions(codes[s[3]:s[1]])
                long = ends - starts >= MIN_RUN
                for a, b in [(s[0], s[1]) for s in spans] + list(zip(starts[long].tolist(), ends[long].tolist())):
                    codes[a:b] = -1
                totals[0] += _transitions(codes)
        yield from _count_rows(totals)

    counted = texts_frame(docs).select(F.col(text_col).cast("string").cast("binary").alias("t")).mapInArrow(run, "label int, cell int, n long")
    return counted.groupBy("label", "cell").agg(F.sum("n").alias("n"))


def sample_counts(samples: DataFrame, value_col: str = "value", label_col: str = "is_secret") -> DataFrame:
    """``(label, cell, n)`` from labelled sample strings."""
    def run(batches):
        totals = np.zeros((2, (N + 1) * N), np.int64)
        for b in batches:
            for t, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t and label is not None:
                    totals[int(label)] += _transitions(_CODE[np.frombuffer(t, np.uint8)])
        yield from _count_rows(totals)

    src = samples.select(F.col(value_col).cast("string").cast("binary").alias("t"), F.col(label_col).cast("int").alias("y"))
    return src.mapInArrow(run, "label int, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame) -> np.ndarray:
    """Log-likelihood ratios [reading, previous or start, next], random over ordinary; reading 1 knows identifier words."""
    totals = np.zeros((2, (N + 1) * N))
    for r in counts.collect():  # at most 2 x 66 x 65 rows
        totals[r.label, r.cell] = r.n
    ordinary, random = totals.reshape(2, N + 1, N)

    def smoothed(t):
        p1 = (t.sum(0) + 1) / (t.sum() + N)
        return (t + 5 * p1) / (t.sum(1, keepdims=True) + 5)

    known = smoothed(ordinary)
    words = sum(_transitions(_CODE[np.frombuffer(w.encode(), np.uint8)]) for w in IDENTIFIER_WORDS)
    # without a sample neither reading may add anything
    named = 0.5 * known + 0.5 * smoothed(words.reshape(N + 1, N).astype(float)) if ordinary.any() else known
    return np.log(0.5 * smoothed(random) + 0.5 / N) - np.log(np.stack((known, named)))


_PART = re.compile(rb"[A-Za-z0-9]+")
_NUMBER = re.compile(rb"(?<![0-9])[0-9]{1,%d}$" % (MIN_RUN - 1))
_HUMP = re.compile(rb"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def _ratio_of(words: list[bytes], ratio: np.ndarray) -> float:
    """Of words one after the other, by one reading's table."""
    total = 0.0
    for w in words:
        codes = _CODE[np.frombuffer(w, np.uint8)]
        total += ratio[N, codes[0]] + ratio[codes[:-1], codes[1:]].sum()
    return total


def looks_random(run: bytes, ratio: np.ndarray) -> bool:
    """Whether a run of alphabet characters passes the bounds, whole or by one long part."""
    total = 0.0
    for part in _PART.findall(run):
        word = _NUMBER.sub(b"", part)
        if not word:
            continue
        score, humps = _ratio_of([word], ratio[0]), _HUMP.sub(b" ", word).split()
        sizes = [len(h) for h in humps]
        if word.isalpha() and min(sizes) >= 2 and max(sizes) <= MAX_WORD and (len(humps) == 1 or len(word) >= MEAN_WORD * len(humps)):
            score = min(score, _ratio_of([h.lower() for h in humps], ratio[1]))
        if len(part) >= MIN_RUN and score >= MIN_RATIO and score >= MIN_MEAN * len(part):
            return True
        total += score
    return bool(total >= MIN_RATIO and total >= MIN_MEAN * len(run))


def all_spans(text: bytes, ratio: np.ndarray) -> list[tuple[int, int, str, int]]:
    """Base spans and Markov spans of one text, in bytes, by start then kind."""
    codes = _CODE[np.frombuffer(text, np.uint8)]
    starts, ends = _runs(codes)
    spans = base_spans(text, starts, ends)
    long = ends - starts >= MIN_RUN
    for a, b in zip(starts[long].tolist(), ends[long].tolist()):
        if any(s[0] < b and a < s[1] for s in spans):
            continue
        if looks_random(text[a:b], ratio):
            spans.append((a, b, "markov", a))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _to_chars(text: bytes, spans):
    """Byte offsets of spans as code point offsets."""
    if not spans or text.isascii():
        return spans
    place = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    at = lambda i: int(place[i - 1]) if i else 0
    return [(at(a), at(b), k, at(v)) for a, b, k, v in spans]


def find(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans array<struct<kind, start, end>>)`` per row."""
    schema = "id long, spans array<struct<kind: string, start: long, end: long>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in batches:
            spans = [[{"kind": k, "start": a, "end": e} for a, e, k, _ in _to_chars(t or b"", all_spans(t or b"", ratio))]
                     for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["id", "spans"])

    src = texts_frame(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return src.mapInArrow(run, schema)


def redact_text(text: bytes, ratio: np.ndarray) -> bytes:
    """The text with each secret value replaced; an assignment keeps its keyword."""
    out, done = [], 0
    for a, b in sorted((s[3], s[1]) for s in all_spans(text, ratio)):
        if a >= done:
            out += [text[done:a], REPLACEMENT.encode()]
        done = max(done, b)
    return b"".join(out) + text[done:]


def redact(docs: DataFrame, ratio: np.ndarray, text_col: str = "text") -> DataFrame:
    """All rows and columns, secret values in ``text_col`` replaced; null stays null."""
    def run(batches):
        for b in batches:
            i = b.schema.get_field_index(text_col)
            texts = [None if t is None else redact_text(t, ratio).decode() for t in b.column(i).cast(pa.binary()).to_pylist()]
            yield b.set_column(i, b.schema.field(i), pa.array(texts, b.schema.field(i).type))

    return texts_frame(docs).mapInArrow(run, docs.schema)
