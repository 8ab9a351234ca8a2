"""Prefix trie of conversations that are rebuilt from a base's head and their own rest.

A sequence of turns is named by a product in a monoid: turn ``t`` is the map
``x -> B x + t`` modulo a prime, a sequence is the composition of its turns' maps. Only
the original conversations are multiplied out. A rebuilt prefix is the base's product
at the end of the head, composed with the quotient of two of the conversation's own
products, and its parent is the quotient by its last turn; no rebuilt text or sequence is
ever put together. Every rebuilt turn is a reference to a stored turn (its conversation
and position) and the digest kept there.

A node is a group of equal (depth, product). The group is verified: all its references
must lead to turns with one digest and all its members must share the parent's product;
by induction over the depth their sequences are then equal. Where a group fails, the
products are made anew with the next multiplier, so names never join different prefixes.

What a subtree sums up is counted without walking it: each node is charged to its
smallest member, and a node's subtree is what is charged to its members, less what its
smallest member was charged above it.

Nothing is gathered by conversation or node: turns are placed by range partitions and
multiplied in blocks of ``BLOCK`` whose products are scanned the same way; groups are
counted before their shuffle; ids of the conversations that end at one node are packed
into texts of ``CHUNK`` ids, in order, and hashed as a stream.

Defined cases: a null role or text is empty; turns order by turn (null first) and then by
their digest, so ties and repeated rows are stable and each is a turn; rows with a null
conversation id belong to no conversation and are left out; a conversation whose rebuilt
sequence is empty is a member of the root only; an empty table has no node, not even a
root. Columns are read by name, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.ranks import positions
from vaultline.session import materialize

#: Turns multiplied at once; ids packed into one text; blocks handled at once inside a task.
BLOCK, CHUNK, AT_ONCE = 1024, 4096, 256
#: The modulus (a Mersenne prime) and the multipliers, in the order they are tried.
PRIME = (1 << 127) - 1
MULTIPLIERS = tuple(int.from_bytes(hashlib.sha256(b"multiplier %d" % k).digest()) % PRIME for k in range(4))
_EMPTY = bytes(16)


def _number(digests: pa.Array) -> list[int]:
    """Turns as numbers: 127 bits of their digests, modulo the prime."""
    return [(int.from_bytes(d[:16]) >> 1) % PRIME for d in digests.to_pylist()]


def _numbers(products: pa.Array) -> list[int]:
    return [int.from_bytes(p or b"") for p in products.to_pylist()]


def _stored(numbers: Sequence[int]) -> pa.Array:
    return pa.array([n.to_bytes(16) for n in numbers], pa.binary())


class _Powers(dict):
    """k -> multiplier to the k."""

    def __init__(self, multiplier: int):
        self.multiplier = multiplier

    def __missing__(self, k: int) -> int:
        if len(self) > 100_000:
            self.clear()
        power = self[k] = pow(self.multiplier, k, PRIME)
        return power


_ELEMENT = "conv long, block long, pos long, length long, product binary, digest binary, size long"


def _multiply(batches, multiplier: int):
    """Blocks of elements -> the elements with the product of all up to them inside the block."""
    power = _Powers(multiplier)
    for b in batches:
        for at in range(0, b.num_rows, AT_ONCE):
            part = b.slice(at, AT_ONCE)
            lists = part.column("items")
            items, owner = lists.flatten(), pc.list_parent_indices(lists)
            field = dict(zip((f.name for f in items.type), items.flatten()))
            given = _numbers(field["product"])
            if at_leaves := field["digest"].null_count < len(items):
                given = _number(field["digest"])
            products, lengths, before = [], [], None
            for o, x, k in zip(owner.to_pylist(), given, field["length"].to_pylist()):
                if o != before:
                    total, length, before = 0, 0, o
                total, length = (total * power[k] + x) % PRIME, length + k
                products.append(total)
                lengths.append(length)
            yield pa.RecordBatch.from_arrays(
                [part.column("conv").take(owner), part.column("block").take(owner), field["pos"], pa.array(lengths, pa.int64()),
                 _stored(products), field["digest"] if at_leaves else pa.nulls(len(items), pa.binary()), field["size"]],
                [c.split()[0] for c in _ELEMENT.split(", ")])


def _compose(batches, multiplier: int):
    """Elements and the product before their block (``head``) -> elements with both composed."""
    power = _Powers(multiplier)
    for b in batches:
        mine, before = _numbers(b.column("product")), _numbers(b.column("head"))
        lengths = b.column("length").to_pylist()
        whole = [(h * power[k] + x) % PRIME for h, x, k in zip(before, mine, lengths)]
        length = pc.add(b.column("length"), b.column("head_length"))
        cols = {"length": length, "product": _stored(whole)}
        names = [c.split()[0] for c in _ELEMENT.split(", ")]
        yield pa.RecordBatch.from_arrays([cols.get(c, b.column(c)) for c in names], names)


def _products(elements: DataFrame, multiplier: int, block: int) -> DataFrame:
    """Elements (conv, pos from 0, length, product or digest, size) -> with the product of all up to them.

    Blocks of aligned positions are multiplied in tasks; a conversation of several
    blocks is the same problem over its blocks' products.
    """
    blocks = (elements.groupBy("conv", F.expr(f"pos div {block}").alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("pos", "length", "product", "digest", "size"))).alias("items")))
    inside = materialize(blocks.mapInArrow(lambda bs: _multiply(bs, multiplier), _ELEMENT), "trie_inside")
    later = inside.where("block > 0")
    if later.isEmpty():
        return inside
    ends = inside.groupBy("conv", "block").agg(F.max(F.struct("pos", "length", "product")).alias("e"))
    totals = ends.select("conv", F.col("block").alias("pos"), "e.length", "e.product", F.lit(None).cast("binary").alias("digest"),
                         F.lit(0).cast("long").alias("size"))
    several = totals.join(later.select("conv").distinct(), "conv", "left_semi")
    heads = _products(several, multiplier, block).select("conv", (F.col("pos") + 1).alias("block"), F.col("length").alias("head_length"),
                                                         F.col("product").alias("head"))
    whole = later.join(heads, ["conv", "block"]).mapInArrow(lambda bs: _compose(bs, multiplier), _ELEMENT)
    return materialize(inside.where("block = 0").unionByName(whole), "trie_products")


def turns_of(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Turns in order: conv, pos (from 0), n (turns of the conversation), digest, size (bytes of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    said = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"))
    return positions(said, ["conv"], ["turn", "digest"], "trie_turns")


_NAMED = "conv long, depth long, node binary, parent binary, digest binary, size long, last boolean"


def _name(batches, multiplier: int):
    """Rebuilt turns -> their nodes and the nodes' parents.

    ``product``: the referenced turn's own product; for a turn after the head, ``minus`` is
    the own product up to the head and ``plus`` the base's, ``after`` the turns since.
    """
    power, inverse = _Powers(multiplier), pow(multiplier, -1, PRIME)
    for b in batches:
        turn = _number(b.column("digest"))
        mine, minus, plus = (_numbers(b.column(c)) for c in ("product", "minus", "plus"))
        after = b.column("after").to_pylist()
        nodes = [(x + (p - m) * power[k]) % PRIME for x, m, p, k in zip(mine, minus, plus, after)]
        parents = [(x - t) * inverse % PRIME for x, t in zip(nodes, turn)]
        yield pa.RecordBatch.from_arrays(
            [b.column("conv"), b.column("depth"), _stored(nodes), _stored(parents), b.column("digest"), b.column("size"),
             pc.equal(b.column("depth"), b.column("len"))], [c.split()[0] for c in _NAMED.split(", ")])


def rebuilt(products: DataFrame, plans: DataFrame, multiplier: int) -> DataFrame:
    """Every rebuilt turn as a node (``_NAMED``), from plans (conv, base, head, taken, n, len).

    The turn is referenced in ``products`` by its conversation and position; ``taken``
    turns come from the base, the rest are the conversation's own after its first ``head``.
    """
    stored = products.select(F.col("conv").alias("ref"), (F.col("pos") + 1).alias("at"), "product", "digest", "size")
    nothing = F.lit(_EMPTY)
    bare = [nothing.alias("minus"), nothing.alias("plus"), F.lit(0).cast("long").alias("after")]
    heads = (plans.where("taken > 0").join(stored, F.col("base") == F.col("ref")).where("at <= taken")
             .select("conv", F.col("at").alias("depth"), "len", "product", *bare, "digest", "size"))
    point = lambda name: products.select(F.col("conv").alias("ref"), (F.col("pos") + 1).alias("at"), F.col("product").alias(name))
    tails = plans.where("n > head")
    tails = tails.join(point("plus"), (F.col("base") == F.col("ref")) & (F.col("taken") == F.col("at")), "left").drop("ref", "at")
    tails = tails.join(point("minus"), (F.col("conv") == F.col("ref")) & (F.col("head") == F.col("at")), "left").drop("ref", "at")
    tails = (tails.join(stored, F.col("conv") == F.col("ref")).where("at > head")
             .select("conv", (F.col("taken") + F.col("at") - F.col("head")).alias("depth"), "len", "product",
                     F.coalesce("minus", nothing).alias("minus"), F.coalesce("plus", nothing).alias("plus"),
                     (F.col("at") - F.col("head")).alias("after"), "digest", "size"))
    return heads.unionByName(tails).mapInArrow(lambda bs: _name(bs, multiplier), _NAMED)


def _verified(groups: DataFrame) -> bool:
    """Whether no (depth, product) holds turns of two digests or members of two parents."""
    return groups.groupBy("depth", "node").count().where("count > 1").isEmpty()


def _hash_ends(batches):
    """Packed ids sorted by (depth, node, chunk) -> (depth, node, SHA-256 of all ids of the node)."""
    now, digest, first = None, None, True
    for b in batches:
        out = []
        for key, ids in zip(zip(b.column("depth").to_pylist(), b.column("node").to_pylist()), b.column("ids").to_pylist()):
            if key != now:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest, first = key, hashlib.sha256(), True
            digest.update((ids if first else "," + ids).encode())
            first = False
        yield _ended(out)
    if now is not None:
        yield _ended([(*now, digest.hexdigest())])


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"depth": pa.array([r[0] for r in rows], pa.int64()),
                                       "node": pa.array([r[1] for r in rows], pa.binary()),
                                       "ends": pa.array([r[2] for r in rows], pa.string())})


def _ends(members: DataFrame) -> DataFrame:
    """(depth, node, ends): SHA-256 of the comma-joined ids, ascending, of the conversations that end there."""
    ranked = positions(members.select("depth", "node", "conv"), ["depth", "node"], ["conv"], "trie_ends")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    packed = ranked.groupBy("depth", "node", F.expr(f"pos div {CHUNK}").alias("chunk")).agg(ids.alias("ids"))
    return (packed.repartition("depth", "node").sortWithinPartitions("depth", "node", "chunk")
            .mapInArrow(_hash_ends, "depth long, node binary, ends string"))


def _charged(nodes: DataFrame, block: int) -> DataFrame:
    """Nodes with ``above``: what their smallest member was charged at smaller depths, summed in segments."""
    cut = nodes.withColumn("segment", F.expr(f"depth div {block}"))
    before = Window.unboundedPreceding, -1
    inside = Window.partitionBy("conv", "segment").orderBy("depth").rowsBetween(*before)
    sums = cut.groupBy("conv", "segment").agg(F.sum("weight").alias("w"))
    earlier = sums.select(F.col("conv").alias("c"), F.col("segment").alias("s"),
                          F.sum("w").over(Window.partitionBy("conv").orderBy("segment").rowsBetween(*before)).alias("earlier"))
    cut = cut.withColumn("inside", F.sum("weight").over(inside))
    return (cut.join(earlier, (F.col("conv") == F.col("c")) & (F.col("segment") == F.col("s")))
            .withColumn("above", F.coalesce("inside", F.lit(0)) + F.coalesce("earlier", F.lit(0)))
            .drop("segment", "inside", "earlier", "c", "s"))


def prefix_trie(conversations: DataFrame, base: Column | None = None, head: Column | None = None, conv_col: str = "conv_id",
                turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                multipliers: Sequence[int] = MULTIPLIERS, block: int = BLOCK) -> DataFrame:
    """One row a node: ``conv`` (smallest member), ``depth``, ``parent_conv``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved`` (bytes of turns that members share, over the subtree) and ``ends`` (SHA-256 of the ids that end here).

    ``base`` and ``head`` are expressions over ``conv``: a conversation is rebuilt from
    the first ``head`` turns of ``base`` (all if fewer, none if it is absent) and its own
    turns after its first ``head``. By default each conversation is as it is.
    """
    turns = materialize(turns_of(conversations, conv_col, turn_col, role_col, text_col), "trie_ordered")
    lengths = turns.where("pos = 0").select("conv", "n")
    plans = lengths.select("conv", "n", (F.col("conv") if base is None else base).cast("long").alias("base"),
                           (F.lit(0) if head is None else head).cast("long").alias("head"))
    bases = lengths.select(F.col("conv").alias("b"), F.col("n").alias("n_base"))
    plans = (plans.join(bases, F.col("base") == F.col("b"), "left").drop("b")
             .withColumn("taken", F.least("head", F.coalesce("n_base", F.lit(0)))).drop("n_base")
             .withColumn("len", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))))
    plans = materialize(plans, "trie_plans")
    elements = turns.select("conv", "pos", F.lit(1).cast("long").alias("length"), F.lit(None).cast("binary").alias("product"), "digest", "size")
    for multiplier in multipliers:
        members = materialize(rebuilt(_products(elements, multiplier, block), plans, multiplier), "trie_members")
        groups = members.groupBy("depth", "node", "parent", "digest").agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.max("size").alias("size"))
        groups = materialize(groups, "trie_groups")
        if _verified(groups):
            break
    else:
        raise RuntimeError("no multiplier gives every prefix a name of its own")

    at_root = F.lit(0).cast("long").alias("depth"), F.lit(_EMPTY).alias("node")
    root = (plans.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0")
            .select(*at_root, F.lit(None).cast("binary").alias("parent"), "n_convs", "conv", F.lit(0).cast("long").alias("size")))
    nodes = groups.drop("digest").unionByName(root)
    children = groups.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = (nodes.join(children, ["depth", "node"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
             .withColumn("weight", (F.col("n_convs") - 1) * F.col("size")))
    nodes = materialize(_charged(nodes, block), "trie_nodes")

    charged = nodes.groupBy("conv").agg(F.sum("weight").alias("weights"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"))
    charged = materialize(charged.where("weights > 0 or leaves > 0"), "trie_charged")
    everywhere = members.select("conv", "depth", "node").unionByName(plans.select("conv", *at_root))
    sums = everywhere.join(charged, "conv").groupBy("depth", "node").agg(F.sum("weights").alias("weights"), F.sum("leaves").alias("n_leaves"))
    ending = members.where("last").select("conv", "depth", "node").unionByName(plans.where("len = 0").select("conv", *at_root))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    return (nodes.join(sums, ["depth", "node"], "left").join(_ends(ending), ["depth", "node"], "left")
            .join(parents, ["depth", "parent"], "left")
            .select("conv", "depth", "parent_conv", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
                    (F.coalesce("weights", F.lit(0)) - F.col("above")).alias("saved"),
                    F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends")))
