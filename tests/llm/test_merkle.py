import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultline.llm import merkle, queries
from vaultline.llm.ranks import positions

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
BEYOND = (1 << 63) - 1
ODD = [(5, "s", "xx", None, None), (None, None, None, 3, "a"), (None, None, None, 3, "a"), (7, "x", "zz", 1, "é"),
       (7, "x", "zz", 1, "é"), (7, "y", "zz", 1, ""), (14, "x", "zz", 1, "b"), (-3, "", "", BEYOND, "long " * 50_000),
       (15, "x", "zé", BEYOND, "12:-"), (28, "-", "\U0001f600", None, "-"), (49, "1:", "￿", 0, "1:2")]


def plain_h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([plain_h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), every level held in Python lists."""
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, add=0: plain_h(*map(said, (*r[:3], None if r[3] is None else r[3] + add, r[4])))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    for rs in groups.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_levels([leaf(r) for r in groups[g]]) for g in names}
    top = plain_levels([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            digest = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            proof = []
            for tree, p in ((trees[g], i), (top, at)):
                for level in tree[:-1]:
                    run = level[p // 2 * 2:p // 2 * 2 + 2]
                    proof += [d for k, d in enumerate(run) if k != p % 2]
                    run[p % 2] = digest
                    digest, p = plain_h(*run), p // 2
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[g][-1][0], root, plain_h(*proof), digest, digest == root))
    return out


def run(df, block):
    out = merkle.manifest(df, tampered={"n_chars": F.col("n_chars").cast("decimal(20, 0)") + 1},
                          where=queries.fold(7) == 0, block=block)
    folded = F.element_at("version", -1)
    return sorted(map(tuple, out.select("id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "proof"), 256), folded,
                                        folded == F.col("root")).collect()), key=str)


@pytest.mark.parametrize("block", [4, merkle.BLOCK])
def test_equals_the_plain_tree(spark, block):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")])
    rows = [*map(tuple, docs.collect()), *ODD]
    got = run(spark.createDataFrame(rows, SCHEMA).repartition(5), block)
    assert got == sorted(plain_manifest(rows), key=str)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 16, 17])
def test_every_size_of_a_group_and_lone_groups(spark, n):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(n)] + [(100, "s", "de", 1, "x")]
    assert run(spark.createDataFrame(rows, SCHEMA), 4) == sorted(plain_manifest(rows), key=str)


def test_many_groups_make_blocks_too(spark):
    rows = [(i, "s", f"l{i:03d}", i, "t") for i in range(70)]
    assert run(spark.createDataFrame(rows, SCHEMA), 4) == sorted(plain_manifest(rows), key=str)


def test_a_version_copies_its_path_only():
    tree = merkle.PersistentTree([merkle._h(b"%d" % i) for i in range(5)], 3)
    before = [list(level) for level in tree.nodes]
    version = tree.version(2, merkle._h(b"new"))
    assert len(version) == 4 and tree.nodes == before
    rebuilt = merkle.PersistentTree([merkle._h(b"new") if i == 2 else d for i, d in enumerate(before[0])], 3)
    assert version == [rebuilt.nodes[k][2 >> k] for k in range(4)]
    assert tree.version(2, before[0][2])[-1] == tree.top


def test_clashing_columns_and_an_empty_table(spark):
    names = "pos long, n long, `group` string, digest string, items string, top string, above string, _tie long, _row long"
    rows = [(i, "s", "en", i, "t", 1, 2, "g", "d", "i", "t", "a", 3, 4) for i in range(6)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, {names}")
    assert run(df, 4) == sorted(plain_manifest([r[:5] for r in rows]), key=str)
    assert run(df.limit(0), 4) == []


def test_positions_of_hot_and_null_groups(spark):
    rows = [("a", k % 7) for k in range(2000)] + [(None, 5), (None, None), ("b", 1)]
    df = spark.createDataFrame(rows, "g string, k long").repartition(6)
    got = sorted(map(tuple, positions(df, ["g"], ["k"]).collect()), key=str)
    want = []
    for g in ("a", None, "b"):
        ks = sorted((k for x, k in rows if x == g), key=lambda k: (k is not None, k or 0))
        want += [(g, k, i, len(ks)) for i, k in enumerate(ks)]
    assert got == sorted(want, key=str)
