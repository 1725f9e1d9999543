"""Mixing of sources to target weights, in DataFrame operations only.

Each source's documents are laid end to end and cut into blocks of ``BLOCK`` words. The output is a row of
slots in shards. Every slot draws its source by a hash, in proportion to the sources' slots, so the counts of a
shard are a multinomial draw of their own. Over all shards such counts miss the targets by chance; so that no source
is overdrawn, a source's drawn slots are numbered by a pseudorandom permutation, and those numbered past its
slots go to the sources that were drawn too seldom, in the order of their names. Of n slots these are about sqrt(n),
spread evenly over the shards.

A source's slot numbers are its passes over its blocks; within a pass a second permutation, of its own per source and
pass, maps them to blocks, which are joined by index. The last block, which may be short, comes last in every pass.
The last pass stops at the word where the target is met, so its last slot may take only the first words of its block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridia.session import materialize

WHITE = " \t\n\x0b\x0c\r"
BLOCK = 128
SHARD_SLOTS = 4096
SHARD_GROUP = 4096
WEIGHTS = (3.0, 1.0, 2.0)
BUDGET, REPEATS = 1.5, 2
# Documents of a source are numbered in groups of about this many words, so no task sees a whole source.
GROUP_WORDS = 1 << 22
ROUNDS = 24
ADDED = ("size", "source_size", "target", "taken")


@dataclass
class Mix:
    """``sources``: sizes, targets and slots; ``slots``: shard, slot, source, block and ``cut``, the number of first
    words taken where that isn't the whole block; ``pieces``: which words of which row stand in which block; ``rows``:
    the documents' rows."""

    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame
    rows: DataFrame


def permuted(value: Column, size: Column, *seed: Column) -> Column:
    """Place of ``value`` in a pseudorandom permutation of 0 .. size - 1.

    Swap-or-not: every round pairs x with (key - x) mod size and a hash of the pair decides whether to swap,
    which is one-to-one for any size and stays far below the range of a long.
    """

    def step(x: Column, r: Column) -> Column:
        key = F.pmod(F.xxhash64(F.lit("key"), r, *seed), size)
        partner = F.pmod(key - x, size)
        swap = F.pmod(F.xxhash64(F.lit("swap"), r, F.greatest(x, partner), *seed), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), value.cast("long"), step)


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Weights repeat over the sources by code point, null last. Targets share ``BUDGET`` times all words by
    weight; a source stops at ``REPEATS`` times its size and the rest is shared again until none is above.
    Sorted by size over weight, the sources that stop are the first ones, so one running sum finds them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    nth = F.row_number().over(by_name) - 1
    rows = sizes.withColumn("weight", F.get(weights, (nth % len(WEIGHTS)).cast("int")))
    rows = rows.withColumn("limit", F.col("source_size").cast("double") * REPEATS)
    rows = rows.withColumn("ratio", F.col("limit") / F.col("weight"))
    upward = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = rows.withColumn("budget", F.sum("source_size").over(whole) * BUDGET)
    rows = rows.withColumn("left", F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    rows = rows.withColumn(
        "open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # The level at which this source and all later ones would be filled; the first that fits is the level.
    rows = rows.withColumn("level", F.col("left") / F.col("open"))
    rows = rows.withColumn("fits", F.col("level") <= F.col("ratio"))
    level = F.min(F.when(F.col("fits"), F.struct("ratio", "source", "level"))).over(whole)["level"]
    rows = rows.withColumn("final", level)
    share = F.least("limit", F.col("weight") * F.coalesce("final", F.lit(float("inf"))))
    return rows.select("source", "source_size", F.when(F.col("source_size") > 0, share).otherwise(0.0).alias("target"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (source_key, doc_id, text_hash, size) with ``start``, the words of the source before each row.

    Rows fall into groups by hash, as many as the table needs; groups' sums are added up first and rows are
    numbered inside their group, so a source with a third of all rows is spread over many tasks.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = max(1, -(-int(total) // GROUP_WORDS))
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(groups)))
    sums = rows.groupBy("source_key", "group").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_key").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_key", "group", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_key", "group").orderBy("doc_id", "text_hash", "row_no")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, ["source_key", "group"])
    return rows.withColumn("start", F.col("offset") + F.col("inner")).drop("group", "inner", "offset")


def _sum_before(column: str) -> Column:
    """Running sum over the sources by name, without the own row."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(in_order), F.lit(0))


def _met(rows: DataFrame, at: str, ranges: DataFrame, begin: str, count: str, total: int) -> DataFrame:
    """Rows joined to the one of ``ranges`` (begin, count) that their number ``at`` below ``total`` falls into.

    Both meet by cells of the numbers' range, so neither side needs to be small.
    """
    cell = max(1, total // 4096)
    last = F.col(begin) + F.col(count) - 1
    cells = F.explode(F.sequence(F.floor(F.col(begin) / cell), F.floor(last / cell)))
    cut = ranges.where(F.col(count) > 0).withColumn("_cell", cells)
    rows = rows.withColumn("_cell", F.floor(F.col(at) / cell))
    return rows.join(cut, "_cell").where((F.col(at) >= F.col(begin)) & (F.col(at) <= last)).drop("_cell")


def _drawn(sources: DataFrame, seed: int) -> DataFrame:
    """``shard, slot, source_key, nth``: the drawn source of every slot and the number of the draw in its source.

    Draws are counted by shard, the counts added up over groups of shards, and slots numbered inside their shard.
    """
    total = int(sources.agg(F.sum("slots")).first()[0] or 0)
    draws = sources.sparkSession.range(total).select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"),
        (F.col("id") % SHARD_SLOTS).alias("slot"),
        F.pmod(F.xxhash64(F.lit("draw"), F.lit(seed), "id"), F.lit(max(total, 1)).cast("long")).alias("draw"),
    )
    drawn = _met(draws, "draw", sources.select("source_key", "first", "slots"), "first", "slots", total)
    drawn = drawn.select("shard", "slot", "source_key")
    counts = drawn.groupBy("shard", "source_key").agg(F.count("*").alias("n"))
    counts = materialize(counts.withColumn("group", F.floor(F.col("shard") / SHARD_GROUP)), "shard-counts")
    groups = counts.groupBy("source_key", "group").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("source_key", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_key", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(groups, ["source_key", "group"])
    before = before.select("shard", "source_key", (F.col("offset") + F.col("inner")).alias("before"))
    in_shard = F.row_number().over(Window.partitionBy("shard", "source_key").orderBy("slot")) - 1
    numbered = drawn.withColumn("in_shard", in_shard).join(before, ["shard", "source_key"])
    return numbered.select("shard", "slot", "source_key", (F.col("before") + F.col("in_shard")).alias("nth"))


def _slots(drawn: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """``shard, slot, source_key, turn, block, cut`` from draws: surplus slots handed over, numbers mapped to blocks."""
    drawn = materialize(drawn, "drawn")
    found = drawn.groupBy("source_key").agg(F.count("*").alias("found"))
    plan = sources.join(found, "source_key", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    plan = plan.withColumn("over", F.greatest(F.col("found") - F.col("slots"), F.lit(0)))
    plan = plan.withColumn("short", F.greatest(F.col("slots") - F.col("found"), F.lit(0)))
    plan = materialize(plan.withColumns({"over_before": _sum_before("over"), "short_before": _sum_before("short")}), "draw-plan")

    of_source = ["source_key", "found", "slots", "over_before"]
    place = permuted(F.col("nth"), F.col("found"), F.lit("place"), F.lit(seed), F.col("source_key"))
    placed = drawn.join(plan.select(*of_source), "source_key").withColumn("number", place)
    # Read twice, and the permutation is what costs here.
    placed = materialize(placed.select("shard", "slot", *of_source, "number"), "placed")
    kept = placed.where("number < slots").select("shard", "slot", "source_key", "number")
    over = placed.where("number >= slots").select(
        "shard", "slot", (F.col("over_before") + F.col("number") - F.col("slots")).alias("nth_over")
    )
    moved = int(plan.agg(F.sum("short")).first()[0] or 0)
    takers = plan.select("source_key", "found", "short", "short_before")
    over = _met(over, "nth_over", takers, "short_before", "short", moved).select(
        "shard", "slot", "source_key", (F.col("found") + F.col("nth_over") - F.col("short_before")).alias("number")
    )
    rows = kept.unionByName(over).join(plan.select("source_key", "blocks", "passes", "rest"), "source_key")
    turn, index, last = F.floor(F.col("number") / F.col("blocks")), F.col("number") % F.col("blocks"), F.col("blocks") - 1
    block = permuted(index, F.greatest(last, F.lit(1)), F.lit(seed), F.col("source_key"), turn)
    left = F.col("rest") - index * BLOCK
    return rows.select(
        "shard", "slot", "source_key", turn.alias("turn"), F.when(index == last, last).otherwise(block).alias("block"),
        F.when((turn == F.col("passes")) & (left < BLOCK), left).alias("cut"),
    )


def mix(docs: DataFrame, seed: int = 1) -> Mix:
    """Plan the mix of ``docs`` (doc_id, text, source).

    A row's size is its number of words, 0 for a null or empty text; a null source is a source of its own.
    Rows that share a doc_id count each for itself. Sources without words have no slots. Other columns are
    not looked at; an empty table gives an empty mix. Reruns over the same rows draw the same mix.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    trimmed = F.btrim(text, F.lit(WHITE))
    size = F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, f"[{WHITE}]+")))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
    )
    # Equal rows are told apart by their number; which of them gets which doesn't matter.
    rows = materialize(
        rows.withColumn("row_no", F.monotonically_increasing_id()).withColumn(
            "source_key", F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
        ),
        "sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = targets(sizes).withColumn("blocks", F.ceil(F.col("source_size") / BLOCK))
    wanted = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0)
    sources = sources.withColumns({"passes": passes, "rest": wanted - passes * F.col("source_size")})
    sources = sources.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / BLOCK))
    sources = sources.withColumn("first", _sum_before("slots"))
    sources = sources.withColumn("source_key", F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))))
    sources = materialize(sources, "sources")
    slots = _slots(_drawn(sources, seed), sources, seed)

    placed = _numbered(rows.where("size > 0"))
    first, last = F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("size") - 1) / BLOCK)
    pieces = placed.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("block") * BLOCK)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK)
    pieces = pieces.select(
        "source_key", "block", "row_no", "doc_id", "text_hash", (begin - F.col("start")).alias("from_word"),
        (end - begin).alias("words"), (begin - F.col("block") * BLOCK).alias("at"),
    )
    return Mix(sources, slots, pieces, rows)


def taken(mixed: Mix) -> DataFrame:
    """Every row of the documents with ``size, source_size, target`` and ``taken``, its words in the mix."""
    # At most one slot of a source is cut.
    times = mixed.slots.groupBy("source_key", "block").agg(
        F.count_if(F.col("cut").isNull()).alias("times"), F.max("cut").alias("cut")
    )
    of_cut = F.greatest(F.least(F.col("words"), F.coalesce("cut", F.lit(0)) - F.col("at")), F.lit(0))
    got = mixed.pieces.join(times, ["source_key", "block"]).groupBy("row_no").agg(
        F.sum(F.col("words") * F.col("times") + of_cut).alias("taken")
    )
    sources = mixed.sources.select("source_key", "source_size", "target")
    return (
        mixed.rows.join(got, "row_no", "left")
        .join(sources, "source_key")
        .select("doc_id", "text_hash", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The documents of the mix, all columns, with ``size``, ``source_size``, ``target`` and ``taken``.

    Rows of which the mix takes no word are not in it. Columns of these four names in ``docs`` are replaced.
    """
    plan = taken(mix(docs, seed)).where("taken > 0")
    # Rows that are equal in id and text share what was drawn for them.
    plan = plan.groupBy("doc_id", "text_hash", "source").agg(
        F.max("size").alias("size"), F.max("source_size").alias("source_size"), F.max("target").alias("target"),
        F.sum("taken").alias("taken"), F.count("*").alias("_n"),
    )
    plan = plan.withColumn("taken", F.col("taken") / F.col("_n")).withColumn("taken", F.round("taken").cast("long"))
    plan = plan.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("source").alias("_source"), *ADDED
    )
    rows = docs.drop(*ADDED)
    same = (
        F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
        & (F.xxhash64(F.col("text").cast("string")) == F.col("_hash"))
        & F.col("source").cast("string").eqNullSafe(F.col("_source"))
    )
    return rows.join(plan, same).select(*(F.col(f"`{c}`") for c in rows.columns), *ADDED)


def mixed_blocks(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The mix itself: ``shard, slot, source, block, turn, n_words, doc_ids, text`` per slot.

    A block's words are taken from the documents' texts, joined by one space; ``doc_ids`` names them in order.
    """
    text = F.col("text").cast("string")
    words = F.split(F.btrim(text, F.lit(WHITE)), f"[{WHITE}]+")
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_hash"), words.alias("_words"))
    texts = texts.dropDuplicates(["_id", "_hash"])
    of_row = mixed.pieces.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("source_key", "block", "row_no", "from_word", "words", "at")).alias("pieces")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    cut = of_row.join(texts, same).select("doc_id", "_words", F.explode("pieces").alias("p"))
    cut = cut.select(
        "p.source_key",
        "p.block",
        F.struct(
            F.col("p.at"),
            F.col("p.row_no"),
            "doc_id",
            F.col("p.words"),
            F.array_join(F.slice("_words", (F.col("p.from_word") + 1).cast("int"), F.col("p.words").cast("int")), " ").alias("text"),
        ).alias("piece"),
    )
    blocks = cut.groupBy("source_key", "block").agg(F.sort_array(F.collect_list("piece")).alias("parts"))
    end = F.coalesce("cut", F.lit(BLOCK))
    all_words = F.array_join(F.transform("parts", lambda p: p["text"]), " ")
    return (
        mixed.slots.join(blocks, ["source_key", "block"])
        .join(mixed.sources.select("source_key", "source"), "source_key")
        .withColumn("parts", F.filter("parts", lambda p: p["at"] < end))
        .select(
            "shard",
            "slot",
            "source",
            "block",
            "turn",
            F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + F.least(p["words"], end - p["at"])).alias("n_words"),
            F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
            F.when(F.col("cut").isNull(), all_words)
            .otherwise(F.array_join(F.slice(F.split(all_words, " "), F.lit(1), F.col("cut").cast("int")), " "))
            .alias("text"),
        )
    )
