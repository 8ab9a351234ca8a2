"""Merkle manifest of a table: a persistent tree of path copies, built in aligned blocks.

Leaves are rows, hashed field by field; per group (null first) they ascend by id. Every
two consecutive digests of a level become one (an odd last one becomes one by itself)
until one remains, the group's subroot; the subroots in group order give the root the
same way. Digests are SHA-256 over their children's lowercase hex text.

Work is laid out in blocks of ``BLOCK`` aligned positions. A task builds the block's
tree once; the digests on top of the blocks are the leaves of the next layer, until a
group is one block. A changed leaf is a new version of the tree: it copies the nodes on
its path inside the block and shares all others, and goes on from the block's top along
the upper path that all versions of a block have in common, in the task of its block.
No group, upper block or root gathers rows: a block is at most ``BLOCK`` rows.

Defined cases: null fields are hashed as ``-``; rows with a null id come first in their
group, with text ``-`` in the leaf, and are never tampered with; rows repeated under one
id are leaves of their own, in the order of their digests (equal rows are
interchangeable); a null group is a group; an empty table has no row; texts of every
length are hashed whole inside the JVM. Columns are read by name, so extra columns
cannot clash.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify, unhexlify
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.ranks import positions, same
from vaultline.session import materialize

#: Aligned positions that a block covers unless told otherwise; a power of two.
BLOCK = 1024


def _h(*parts: bytes) -> bytes:
    return hexlify(hashlib.sha256(b"".join(parts)).digest())


class PersistentTree:
    """Digests (hex) over aligned leaves; versions copy a path and share the rest.

    ``levels`` is how often the leaves are halved: a block inside a larger tree goes up
    to its own top even where it holds few leaves, because a lone digest is hashed again.
    """

    def __init__(self, leaves: Sequence[bytes], levels: int):
        self.nodes = [list(leaves)]
        for _ in range(levels):
            below = self.nodes[-1]
            self.nodes.append([_h(*below[i:i + 2]) for i in range(0, len(below), 2)])

    @property
    def top(self) -> bytes:
        return self.nodes[-1][0]

    def siblings(self, pos: int) -> list[tuple[bytes, bytes]]:
        """Per level, the digests (left, right) beside the path; an empty one is none."""
        out = []
        for nodes in self.nodes[:-1]:
            beside = nodes[pos ^ 1] if pos ^ 1 < len(nodes) else b""
            out.append((beside, b"") if pos & 1 else (b"", beside))
            pos >>= 1
        return out

    def version(self, pos: int, leaf: bytes) -> list[bytes]:
        """The nodes copied for a changed leaf, from the leaf to the top; all others are shared."""
        copied = [leaf]
        for left, right in self.siblings(pos):
            copied.append(_h(left, copied[-1], right))
        return copied


def _levels(n: int) -> int:
    """Halvings until one of ``n`` digests remains."""
    return max(n - 1, 0).bit_length()


def _pack(path: list[tuple[bytes, bytes]]) -> bytes:
    """A path as bytes: per level a side (0 none, 1 left, 2 right) and the sibling's digest."""
    return b"".join(b"\1" + unhexlify(a) if a else b"\2" + unhexlify(b) if b else b"\0" for a, b in path)


def _unpack(packed: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(packed):
        side = packed[at]
        digest = hexlify(packed[at + 1:at + 33]) if side else b""
        out.append((digest, b"") if side == 1 else (b"", digest))
        at += 33 if side else 1
    return out


def _tree(items: list[dict], n: int, size: int) -> PersistentTree:
    return PersistentTree([hexlify(i["digest"]) for i in items], min(_levels(n), size.bit_length() - 1))


def _rows(batches, *columns):
    """One row at a time: a block is large, so a batch is never turned into Python objects whole."""
    for b in batches:
        taken = [b.column(c) for c in columns]
        for k in range(b.num_rows):
            yield [c[k].as_py() for c in taken]


def _blocks(nodes: DataFrame, extra: Sequence[str], size: int, name: str) -> DataFrame:
    """Stored blocks of nodes (group, pos, n, digest): ``size`` items by position at most; ``n``: nodes of the group."""
    item = F.struct("pos", "digest", *extra)
    return materialize(nodes.groupBy("group", F.shiftright("pos", size.bit_length() - 1).alias("block"), "n")
                       .agg(F.array_sort(F.collect_list(item)).alias("items")), name)


def _tops(batches, size):
    for group, block, n, items in _rows(batches, "group", "block", "n", "items"):
        yield pa.RecordBatch.from_pydict({"group": pa.array([group], pa.string()), "pos": [block], "n": [-(-n // size)],
                                          "digest": pa.array([unhexlify(_tree(items, n, size).top)], pa.binary())})


def _climb(batches, size):
    for group, n, items, above, top in _rows(batches, "group", "n", "items", "above", "top"):
        tree = _tree(items, n, size)
        yield pa.RecordBatch.from_pydict({
            "group": pa.array([group] * len(items), pa.string()), "block": [i["pos"] for i in items],
            "above": pa.array([_pack(tree.siblings(k)) + above for k in range(len(items))], pa.binary()),
            "top": pa.array([top] * len(items), pa.binary())})


def _upper_paths(blocks: DataFrame, size: int) -> DataFrame:
    """(group, block, above, top): the siblings above a block's top and the group's topmost digest."""
    tops = materialize(blocks.select("group", "block", "n", "items")
                       .mapInArrow(lambda bs: _tops(bs, size), "group string, pos long, n long, digest binary"), "merkle_tops")
    alone = tops.where("n = 1").select("group", F.col("pos").alias("block"), F.unhex(F.lit("")).alias("above"), F.col("digest").alias("top"))
    many = tops.where("n > 1")
    if many.isEmpty():
        return alone
    layer = _blocks(many, [], size, "merkle_upper")
    above = _upper_paths(layer, size)
    joined = layer.join(above, same(["group", "block"], layer, above)).select(layer["group"], "n", "items", "above", "top")
    return alone.unionByName(joined.mapInArrow(lambda bs: _climb(bs, size), "group string, block long, above binary, top binary"))


def leaf_text(fields: Sequence[Column]) -> Column:
    """Fields as bytes count, colon, value, one after the other; null as ``-``."""
    def one(c: Column) -> Column:
        text = c.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.concat(*map(one, fields))


_ROW = "id long, leaf string, subroot string, root string, proof array<string>, version array<string>"


def _group_proofs(batches, size):
    """Blocks of subroots -> (group, beyond, subroot, root): the path from a group's subroot to the root."""
    for n, items, above, top in _rows(batches, "n", "items", "above", "top"):
        tree = _tree(items, n, size)
        yield pa.RecordBatch.from_pydict({
            "group": pa.array([i["name"] for i in items], pa.string()),
            "beyond": pa.array([_pack(tree.siblings(k)) + above for k in range(len(items))], pa.binary()),
            "subroot": pa.array([i["digest"] for i in items], pa.binary()), "root": pa.array([top] * len(items), pa.binary())})


def _prove(batches, size):
    """Blocks with the paths above them -> one row a leaf: its proof and the nodes of its version."""
    for n, items, above, beyond, subroot, root in _rows(batches, "n", "items", "above", "beyond", "subroot", "root"):
        tree, upper = _tree(items, n, size), _unpack(above) + _unpack(beyond)
        below, proofs, versions = [], [s.decode() for pair in upper for s in pair if s], []
        for pos, item in enumerate(items):
            version = tree.version(pos, tree.nodes[0][pos] if item["changed"] is None else hexlify(item["changed"]))
            for left, right in upper:  # the version goes on above its block
                version.append(_h(left, version[-1], right))
            versions.append([v.decode() for v in version])
            below.append([s.decode() for pair in tree.siblings(pos) for s in pair if s])
        yield pa.RecordBatch.from_pydict({
            "id": pa.array([i["id"] for i in items], pa.int64()), "leaf": [d.decode() for d in tree.nodes[0]],
            "subroot": [subroot.hex()] * len(items), "root": [root.hex()] * len(items),
            "proof": pa.array([b + proofs for b in below], pa.list_(pa.string())),
            "version": pa.array(versions, pa.list_(pa.string()))})


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
             fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             tampered: dict[str, Column] | None = None, where: Column | None = None,
             block: int = BLOCK) -> DataFrame:
    """One row a document: ``id, leaf, subroot, root, proof, version`` (hex digests).

    ``fields`` are hashed into the leaf in this order. ``tampered`` gives columns another
    value in the rows that ``where`` selects (default: all); each such row is a version of
    the tree. ``version`` lists the nodes that the version copies, its leaf first and its
    own root last; a row that is not tampered with recomputes its path from its own leaf.
    ``proof`` lists the siblings on the path, level by level, left to right.
    """
    leaf = F.unhex(F.sha2(leaf_text([F.col(c) for c in fields]), 256))
    changed = F.lit(None).cast("binary")
    if tampered:
        now = F.unhex(F.sha2(leaf_text([tampered.get(c, F.col(c)) for c in fields]), 256))
        changed = now if where is None else F.when(where & F.col(id_col).isNotNull(), now)
    leaves = docs.select(F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("group"),
                         leaf.alias("digest"), changed.alias("changed"))
    blocks = _blocks(positions(leaves, ["group"], ["id", "digest"], "merkle"), ["id", "changed"], block, "merkle_blocks")
    above = materialize(_upper_paths(blocks, block), "merkle_above")
    subroots = above.where("block = 0").select(F.col("group").alias("name"), F.col("top").alias("digest"))
    ranked = positions(subroots, [], ["name"], "merkle_groups").withColumn("group", F.lit(""))
    top_blocks = _blocks(ranked, ["name"], block, "merkle_group_blocks")
    over = _upper_paths(top_blocks, block)
    groups = (top_blocks.join(over, same(["group", "block"], top_blocks, over)).select("n", "items", "above", "top")
              .mapInArrow(lambda bs: _group_proofs(bs, block), "group string, beyond binary, subroot binary, root binary"))
    groups = materialize(groups, "merkle_group_paths")
    paths = above.join(groups, same(["group"], above, groups)).select(above["group"], "block", "above", "beyond", "subroot", "root")
    return (blocks.join(paths, same(["group", "block"], blocks, paths))
            .select("n", "items", "above", "beyond", "subroot", "root").mapInArrow(lambda bs: _prove(bs, block), _ROW))
