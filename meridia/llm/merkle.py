"""Merkle manifest: a hash tree over each group's rows and over the groups, with a proof for every row.

Leaves of a group stand in their order; every ``FAN`` consecutive nodes become one until one is left, the
group's subroot; subroots, in the groups' order, become the root in the same way. A node first holds the
segment of its proof that leads to its parent: the other nodes of its run. Self-joins of the nodes then
append to every segment the one of the node it leads to, which doubles the distance it spans, so that a
tree of depth d takes about log2(d) of them until each leaf's segment reaches the root.

Only levels that a later round needs take part: in the round of distance d those that 2d divides are joined
with those that leave remainder d, so the nodes shrink threefold per level while the segments grow.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridia.session import materialize

FAN = 3

# Levels that are made from one another inside a row of FAN ** LEVELS nodes, between two shuffles.
LEVELS = 4

# Leaves of one group that meet a copy of its subroot's proof in one task.
LEAVES_PER_COPY = 1 << 16


def sized(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` for null, else its bytes in UTF-8, a colon and its text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(sized, fields)), 256)


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``idx``, the place of each row in its ``tree`` from 0, and ``leaves``, the tree's size.

    Rows are dealt by ranges of (tree, order) and counted within each range, so a tree is never sorted in one
    task; a drawn number spreads equal rows, whose order does not matter. The ranges are written before they
    are counted, so a retry cannot deal them anew.
    """
    order_by = [F.col(c).asc_nulls_first() for c in order]
    ranged = rows.withColumn("_draw", F.rand(11)).repartitionByRange(F.col("tree"), *order_by, F.col("_draw"))
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "merkle-leaves")
    counts = ranged.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("tree", "_range", before.alias("_before"), F.sum("_n").over(whole).alias("leaves"))
    nth = F.row_number().over(Window.partitionBy("tree", "_range").orderBy(*order_by, "_draw"))
    placed = ranged.withColumn("_nth", nth).join(offsets, ["tree", "_range"])
    return placed.withColumn("idx", F.col("_nth") - 1 + F.col("_before")).drop("_draw", "_range", "_nth", "_before")


def _size(level: int) -> Column:
    """Nodes of a tree on a level."""
    return F.ceil(F.col("leaves") / FAN**level)


def _run(hashes: Column, first: Column, size: int | Column) -> Column:
    """Hex text of ``size`` nodes from 0-based ``first`` on, fewer at the end."""
    return F.array_join(F.slice(hashes, first.cast("int") + 1, size), "")


def _parents(hashes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda r: F.sha2(_run(hashes, r * FAN, FAN), 256))


def _step(hashes: Column, i: Column) -> Column:
    """Proof step of the node at ``i``: a byte with its place in its run, then the digests of the others."""
    place = (i % FAN).cast("int")
    left = _run(hashes, i - place, place)
    right = _run(hashes, i + 1, F.lit(FAN - 1) - place)
    return F.unhex(F.concat(F.lit("0"), place.cast("string"), left, right))


def _blocks(nodes: DataFrame, base: int) -> DataFrame:
    """Rows of up to FAN ** LEVELS consecutive nodes of level ``base``, and the levels above that they decide.

    ``payload`` and ``level0`` are arrays over the nodes; ``level1`` and so on hold the hashes above them, null
    beyond the subroot.
    """
    block = F.floor(F.col("idx") / FAN**LEVELS).alias("block")
    rows = nodes.groupBy("tree", "leaves", block).agg(
        F.array_sort(F.collect_list(F.struct("idx", "hash", "payload"))).alias("_nodes")
    )
    rows = rows.withColumn("payload", F.col("_nodes.payload")).withColumn("level0", F.col("_nodes.hash"))
    for j in range(1, LEVELS + 1):
        rows = rows.withColumn(f"level{j}", F.when(_size(base + j - 1) > 1, _parents(F.col(f"level{j - 1}"))))
    return rows.drop("_nodes")


def _nodes_of(blocks: DataFrame, base: int, j: int) -> DataFrame:
    """Nodes below a parent on level ``base + j``: ``tree, level, idx, hash, segment``."""
    hashes = F.col(f"level{j}")
    made = F.transform(
        hashes,
        lambda h, i: F.struct(
            (F.col("block") * FAN ** (LEVELS - j) + i).alias("idx"), h.alias("hash"),
            F.array(_step(hashes, i)).alias("segment"),
        ),
    )
    return blocks.where(_size(base + j) > 1).select("tree", F.lit(base + j).alias("level"), F.inline(made))


def _leaves_of(blocks: DataFrame) -> DataFrame:
    """Leaves with payload: ``tree, level, idx, hash, payload, segment``; a lone leaf has an empty segment."""
    hashes = F.col("level0")
    made = F.transform(
        hashes,
        lambda h, i: F.struct(
            (F.col("block") * FAN**LEVELS + i).alias("idx"), h.alias("hash"), F.get("payload", i).alias("payload"),
            F.filter(F.array(_step(hashes, i)), lambda _: F.col("leaves") > 1).alias("segment"),
        ),
    )
    return blocks.select("tree", F.lit(0).alias("level"), F.inline(made))


def _subroots_of(blocks: DataFrame, base: int) -> list[DataFrame]:
    lone = [blocks.where("leaves = 1").select("tree", "leaves", F.col("level0")[0].alias("hash"))] if not base else []
    return lone + [
        blocks.where((_size(base + j) == 1) & (_size(base + j - 1) > 1)).select(
            "tree", "leaves", F.col(f"level{j}")[0].alias("hash")
        )
        for j in range(1, LEVELS + 1)
    ]


def _jump(lower: DataFrame, upper: DataFrame, distance: int) -> DataFrame:
    """Appends to each segment of ``lower`` the segment of the node ``distance`` levels above.

    FAN ** distance nodes share that node; keys are those of nodes half way between, for which the upper
    node is repeated, so that neither the groups nor the copies outgrow the square root of that number.
    """
    half = (distance + 1) // 2
    copies = FAN ** (distance - half)
    keys = F.sequence(F.col("idx") * copies, (F.col("idx") + 1) * copies - 1)
    more = upper.select(
        "tree", (F.col("level") - distance).alias("level"), F.explode(keys).alias("_key"),
        F.col("segment").alias("_more"),
    )
    keyed = lower.withColumn("_key", F.floor(F.col("idx") / FAN**half))
    met = keyed.join(more, ["tree", "level", "_key"], "left")
    longer = F.when(F.col("_more").isNull(), F.col("segment")).otherwise(F.concat("segment", "_more"))
    return met.withColumn("segment", longer).drop("_key", "_more")


def forest(leaves: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Hash trees over ``leaves``: ``tree`` (not null), ``hash``, ``payload`` and the columns of ``order``.

    Returns the leaves as ``tree, idx, hash, payload, segment``, where ``segment`` leads from the leaf to its
    tree's subroot, and the subroots as ``tree, leaves, hash``.
    """
    kept = ["tree", "leaves", "idx", "hash", "payload"]
    nodes = materialize(_placed(leaves, order).select(*kept), "merkle-nodes")
    most = nodes.agg(F.max("leaves")).first()[0] or 0
    bottom, above, subroots, base = None, [], [], 0
    while bottom is None or FAN**base < most:
        blocks = materialize(_blocks(nodes, base), "merkle-blocks")
        bottom = _leaves_of(blocks) if bottom is None else bottom
        above += [_nodes_of(blocks, base, j) for j in range(0 if base else 1, LEVELS)]
        subroots += _subroots_of(blocks, base)
        base += LEVELS
        top = F.col(f"level{LEVELS}")[0].alias("hash")
        nothing = F.lit(None).cast(nodes.schema["payload"].dataType).alias("payload")
        nodes = blocks.where(_size(base) > 1).select("tree", "leaves", F.col("block").alias("idx"), top, nothing)
    upper, distance = functools.reduce(DataFrame.unionByName, above), 1
    while FAN**distance < most:
        far = upper.where(F.col("level") % (2 * distance) == distance)
        bottom = _jump(bottom, far.where(F.col("level") == distance), distance)
        near = upper.where(F.col("level") % (2 * distance) == 0)
        upper = materialize(_jump(near, far, distance), "merkle-segments")
        distance *= 2
    return bottom.drop("level"), materialize(functools.reduce(DataFrame.unionByName, subroots), "merkle-subroots")


def manifest(rows: DataFrame, fields: Sequence[str], group: str, order: str, keep: Sequence[str] = ()) -> DataFrame:
    """Tree over every row, by group: the columns of ``keep``, ``leaf, subroot, root, path``.

    A leaf hashes the sized ``fields`` in their order. Leaves of a group ascend by ``order``, null first, equal
    ones by their hash; groups ascend by their text, null first. ``path`` holds a step for every level from the
    leaf to the root: see ``folded`` and ``proof_digest``. Rows that are alike in all fields are leaves of their
    own with proofs of their own. A text of any length only enters its leaf. No rows give none.
    """
    by = F.col(group).cast("string")
    leaves = rows.select(
        F.when(by.isNull(), "n").otherwise(F.concat(F.lit("v"), by)).alias("tree"),
        F.col(order).alias("_order"),
        leaf_hash([F.col(c) for c in fields]).alias("hash"),
        F.struct(F.lit(0).alias("_"), *keep).alias("payload"),
    )
    # Texts are hashed once: finding ranges reads the leaves twice.
    below, subroots = forest(materialize(leaves, "merkle-hashes"), ["_order", "hash"])
    tops = subroots.select(
        F.lit("").alias("tree"), "hash", F.struct("tree", "leaves").alias("payload"), F.col("tree").alias("_order")
    )
    above, root = forest(tops, ["_order"])
    found = root.first()
    copies = F.sequence(F.lit(0), F.floor((F.col("payload.leaves") - 1) / LEAVES_PER_COPY))
    rest = above.select(
        "payload.tree", F.explode(copies).alias("_copy"), F.col("hash").alias("subroot"), F.col("segment").alias("_more")
    )
    met = below.withColumn("_copy", F.floor(F.col("idx") / LEAVES_PER_COPY)).join(rest, ["tree", "_copy"])
    return met.select(
        *[F.col(f"payload.`{c}`").alias(c) for c in keep], F.col("hash").alias("leaf"), "subroot",
        F.lit(found["hash"] if found else None).cast("string").alias("root"), F.concat("segment", "_more").alias("path"),
    )


def folded(leaf: Column, path: Column) -> Column:
    """Root that a leaf gives with the steps of a path."""

    def up(node: Column, step: Column) -> Column:
        text = F.lower(F.hex(step))
        cut = F.substring(text, 2, 1).cast("int") * 64
        left = F.substr(text, F.lit(3), cut)
        return F.sha2(F.concat(left, node, F.substr(text, cut + 3)), 256)

    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """Hash of the digests on a path in their order, as hex text; of nothing where there are none."""
    others = F.array_join(F.transform(path, lambda step: F.substr(F.lower(F.hex(step)), F.lit(3))), "")
    return F.sha2(others, 256)
