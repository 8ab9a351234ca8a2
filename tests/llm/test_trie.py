import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def crc(c):
    return zlib.crc32(str(c).encode())


def plain_trie(rows, rebuild=True):
    """Every prefix held as a tuple of (role, text); ties of a turn in the order of their digests."""
    said = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            said.setdefault(c, []).append((t is not None, t or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in said.items()}
    whole = {}
    for c, turns in own.items():
        h = crc(c) % 9 if rebuild else 0
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members, children = {}, {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k, cs in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(cs) - 1) * len(k[-1][1].encode()) if k else 0
    sha = lambda k, cs: hashlib.sha256(",".join(str(c) for c in sorted(cs) if whole[c] == k).encode()).hexdigest()
    return sorted(((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), len(children.get(k, ())), leaves[k],
                    saved[k], sha(k, cs)) for k, cs in members.items()), key=str)


def run(df, rebuild=True, **kw):
    c = F.col("conv")
    if rebuild:
        kw |= {"base": c - c % 5, "head": F.crc32(c.cast("string")) % 9}
    return sorted(map(tuple, trie.prefix_trie(df, **kw).collect()), key=str)


def conversations(rng, n=60):
    """Shared first turns, whole copies, ids without a base, long ones, null and repeated turns."""
    rows = []
    for c in [c for c in range(n) if c % 25] + [1000, 1003, 1004]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, t, ("user", "assistant", None)[t % 3], rng.choice(["hello", "é ü", "", None, f"only {rng.randrange(4)}"])))
    copy = [(t, ("user", "assistant")[t % 2], f"same {t}") for t in range(11)]
    rows += [(2000 + 5 * k, t, r, x) for k in range(40) for t, r, x in copy]
    rows += [(1000, None, "user", "no turn"), (1000, None, "user", "no turn"), (1000, 2, "a", "tie"), (1000, 2, "ab", "tie"),
             (None, 0, "user", "nobody"), (1003, 0, "a", "bc"), (1004, 0, "ab", "c"), (7, 99, "x", "long " * 20_000)]
    return rows + [(3000, t, "user", f"t{t % 3}") for t in range(70)]


@pytest.mark.parametrize("block", [4, trie.BLOCK])
def test_equals_the_plain_trie(spark, block):
    rows = conversations(random.Random(block))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert run(df, block=block) == plain_trie(rows)


def test_conversations_as_they_are(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()] + conversations(random.Random(1), 20)
    assert run(spark.createDataFrame(rows, SCHEMA), rebuild=False) == plain_trie(rows, rebuild=False)


def test_a_name_for_two_prefixes_is_found_out(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "z"), (2, 0, "u", "b"), (2, 1, "u", "z"), (3, 0, "u", "a"), (3, 1, "u", "z")]
    df, weak = spark.createDataFrame(rows, SCHEMA), trie.PRIME + 1  # 1: a product is a sum of turns
    swapped = rows + [(4, 0, "u", "z"), (4, 1, "u", "a")]
    both = spark.createDataFrame(swapped, SCHEMA)
    assert run(df, rebuild=False, multipliers=[weak]) == plain_trie(rows, rebuild=False)
    with pytest.raises(RuntimeError):
        run(both, rebuild=False, multipliers=[weak])
    assert run(both, rebuild=False, multipliers=[weak, trie.MULTIPLIERS[0]]) == plain_trie(swapped, rebuild=False)


def test_packed_ids_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = [(c, 0, "user", "same") for c in [*range(-30, 130), 10**12]]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(4), rebuild=False) == plain_trie(rows, rebuild=False)


def test_clashing_columns_turnless_and_empty(spark):
    rows = [(1, 0, "u", "gone"), (6, 0, "u", "x")]  # conversation 1 keeps no turn: its base is absent and its head longer
    assert crc(1) % 9 >= 1 and any(r[1] == 0 and r[3] == 2 for r in plain_trie(rows))
    names = "conv long, pos long, n long, size long, depth long, node string, product string, base long, head long"
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, "n", "p", 6, 7) for r in rows], f"{SCHEMA}, {names}")
    assert run(df) == plain_trie(rows)
    assert run(df.limit(0)) == []
