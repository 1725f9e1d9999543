"""Benchmark decontamination by spaced seeds: hashes of masked token positions, joined, then aligned.

A mask keeps some positions of a run of tokens and ignores the others, so a run with a substituted token at
an ignored place still hashes alike. The masks together hit every overlap of ``MIN_TOKENS`` tokens or more with
``IDENTITY_PERCENT`` of them equal: all patterns of 13 to 25 tokens were counted, and a longer overlap can be cut
into pieces of 13 to 25 tokens, of which one at least has no more than its share of substitutions. Around every hit document and item are laid side by side; the longest stretch
that agrees in at least ``IDENTITY`` of its tokens decides.

Tokens are runs of characters other than white space and ASCII punctuation, A-Z in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.llm.words import WHITE_AND_PUNCTUATION, chunks, mix, split
from meridia.session import materialize

# Fixed masks (1: position counts), found by search over all substitutions allowed in 13 to 25 tokens.
MASKS = ("1111100101", "11011111", "11001010111", "11100001010011", "11010100000111", "110101000001011")
MIN_TOKENS = 13
# Shorter items count when they occur whole; below this length an item says nothing and is left out.
SHORTEST_ITEM = 5
IDENTITY_PERCENT = 80
# The filter that decides which document hashes are shuffled: 2 MB, whatever the sizes of the tables.
FILTER_BITS = 24

_OFFSETS = [np.flatnonzero(np.frombuffer(m.encode(), np.uint8) == ord("1")) for m in MASKS]
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def seeds(tokens: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Seed hashes of every start, with the span they cover, one pair per mask."""
    for offsets in _OFFSETS:
        span = int(offsets[-1]) + 1
        n = len(tokens) - span + 1
        if n > 0:
            yield _combined(tokens, offsets, n), span


def _combined(tokens: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    total = np.full(n, int(offsets[-1]) * int(_FACTORS[63]) % (1 << 64), np.uint64)
    for i, o in enumerate(offsets):
        total += tokens[o : o + n] * _FACTORS[i]
    return mix(total + np.uint64(len(offsets)))


def _token_lists(texts: list[str]) -> Iterator[np.ndarray]:
    for lo, hi in chunks(texts):
        words = split(texts[lo:hi], separators=WHITE_AND_PUNCTUATION)
        hashes = words.hashes
        for s, e in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            yield hashes[s:e]


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items as token lists with their seeds: of all masks, or of the whole item when that is short."""
    for batch in batches:
        lists, seed_lists = [], []
        for tokens in _token_lists([t or "" for t in batch.column(1).to_pylist()]):
            n = len(tokens)
            found = []
            if n >= MIN_TOKENS:
                for hashes, _ in seeds(tokens):
                    found += [{"seed": int(h), "at": i} for i, h in enumerate(hashes.view(np.int64))]
            elif n >= SHORTEST_ITEM:
                whole = _combined(tokens, np.arange(n), 1).view(np.int64)
                found.append({"seed": int(whole[0]), "at": 0})
            lists.append(tokens.view(np.int64))
            seed_lists.append(found)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lists, pa.list_(pa.int64())),
             pa.array(seed_lists, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))],
            names=["item_id", "item_tokens", "seeds"],
        )


def _in_filter(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether both of a hash's bits are set."""
    mask = np.uint64((1 << FILTER_BITS) - 1)
    one, two = hashes & mask, (hashes >> np.uint64(FILTER_BITS)) & mask
    hit = (bits[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8)) & 1
    where = np.flatnonzero(hit)
    two = two[where]
    hit_two = (bits[two >> np.uint64(3)] >> (two & np.uint64(7)).astype(np.uint8)) & 1
    return where[hit_two.astype(bool)]


def _hit_batches(bits_of: object, short: list[int]):
    """Per document: its tokens and the seeds that may be an item's; no tokens where there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bits_of.value, np.uint8)
        for batch in batches:
            lists, seed_lists, at_lists = [], [], []
            for tokens in _token_lists([t or "" for t in batch.column(2).to_pylist()]):
                found, at = [], []
                whole = (_combined(tokens, np.arange(n), len(tokens) - n + 1) for n in short if len(tokens) >= n)
                for hashes in (*(h for h, _ in seeds(tokens)), *whole):
                    where = _in_filter(hashes, bits)
                    if len(where):
                        found.append(hashes[where].view(np.int64))
                        at.append(where.astype(np.int32))
                lists.append(tokens.view(np.int64) if found else None)
                seed_lists.append(np.concatenate(found) if found else None)
                at_lists.append(np.concatenate(at) if found else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64())),
                 pa.array(seed_lists, pa.list_(pa.int64())), pa.array(at_lists, pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "doc_tokens", "seeds", "at"],
            )

    return run


def longest_overlap(equal: np.ndarray, percent: int = IDENTITY_PERCENT) -> tuple[int, int, int]:
    """Start, length and matches of the longest stretch with at least ``percent`` equal places; first if tied."""
    weight = np.where(equal, 100 - percent, -percent).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(weight)])
    # The best start before an end is the first place whose sum is not above the end's.
    lows = np.minimum.accumulate(sums)
    first = len(sums) - np.searchsorted(lows[::-1], sums, side="right")
    length = np.arange(len(sums)) - np.minimum(first, np.arange(len(sums)))
    end = int(np.argmax(length))
    start = end - int(length[end])
    return start, end - start, int(equal[start:end].sum())


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, begin, size, match = [], [], [], []
        for i in range(batch.num_rows):
            doc = batch.column(3)[i].values.to_numpy(zero_copy_only=False)
            item = batch.column(4)[i].values.to_numpy(zero_copy_only=False)
            shift = batch.column(2)[i].as_py()
            lo, hi = max(0, shift), min(len(doc), shift + len(item))
            equal = doc[lo:hi] == item[lo - shift : hi - shift]
            if len(item) < MIN_TOKENS:
                good = len(equal) == len(item) and bool(equal.all())
                start, length, matches = 0, len(item), len(item)
            else:
                start, length, matches = longest_overlap(equal)
                good = length >= MIN_TOKENS
            if good:
                keep.append(i)
                begin.append(lo + start)
                size.append(length)
                match.append(matches)
        out = batch.select([0, 1]).take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*out.columns, pa.array(begin, pa.int32()), pa.array(size, pa.int32()), pa.array(match, pa.int32())],
            names=["row_no", "item_no", "start", "length", "matches"],
        )


def overlaps(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows of ``docs`` with a row number, and the benchmark overlaps found in them.

    The second table has ``row_no, item_no, item_id, start, length, matches``: the longest stretch of tokens on one
    alignment of a document and an item, from token ``start`` of the document.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("t"))
    items = materialize(
        items.mapInArrow(
            _item_batches, "item_id long, item_tokens array<long>, seeds array<struct<seed: long, at: int>>"
        ),
        "items",
    )
    # Items are told apart by a number of their own: ids may be null or repeated.
    items = materialize(items.withColumn("item_no", F.monotonically_increasing_id()), "items")
    of_items = items.select("item_no", F.explode("seeds").alias("s")).select(
        "item_no", F.col("s.seed").alias("seed"), F.col("s.at").alias("item_at")
    )
    bits = spark.sparkContext.broadcast(_filter_of(of_items))
    n = F.size("item_tokens")
    short = [r.n for r in items.where((n >= SHORTEST_ITEM) & (n < MIN_TOKENS)).select(n.alias("n")).distinct().collect()]
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    marked = rows.mapInArrow(
        _hit_batches(bits, sorted(short)),
        "doc_id long, text_hash long, doc_tokens array<long>, seeds array<long>, at array<int>",
    )
    marked = materialize(marked.withColumn("row_no", F.monotonically_increasing_id()), "hits")
    hit = marked.where("doc_tokens IS NOT NULL")
    pairs = (
        hit.select("row_no", F.explode(F.arrays_zip("seeds", "at")).alias("s"))
        .select("row_no", F.col("s.seeds").alias("seed"), F.col("s.at").alias("doc_at"))
        .join(of_items, "seed")
        .select("row_no", "item_no", (F.col("doc_at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    found = (
        pairs.join(items.select("item_no", "item_tokens"), "item_no")
        .join(hit.select("row_no", "doc_tokens"), "row_no")
        .select("row_no", "item_no", "shift", "doc_tokens", "item_tokens")
        .mapInArrow(_verify_batches, "row_no long, item_no long, start int, length int, matches int")
        .join(items.select("item_no", "item_id"), "item_no")
    )
    return marked.select("row_no", "doc_id", "text_hash"), found


def _filter_of(of_items: DataFrame) -> bytes:
    """Bit table of fixed size with two bits per seed, put together from one sum per 32 bits."""
    mask = (1 << FILTER_BITS) - 1
    bit = F.explode(
        F.array(F.col("seed").bitwiseAND(mask), F.shiftrightunsigned("seed", FILTER_BITS).bitwiseAND(mask))
    )
    words = (
        of_items.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 5).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 AS int))")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.tobytes()


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_hash, n_items, item_id, longest, matches, contaminated``.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are not looked at.
    ``n_items`` counts the items with an overlap, ``item_id`` is the smallest among those with the longest,
    ``matches`` its agreeing tokens. An item of ``SHORTEST_ITEM`` to ``MIN_TOKENS`` - 1 tokens must occur
    whole. Null and empty texts and rows without an overlap get 0, null item_id and false. Equal rows get
    equal results; a null doc_id is judged like any other. With an empty benchmark nothing is contaminated.
    """
    rows, found = overlaps(docs, benchmark)
    best = (
        found.groupBy("row_no", "item_no", "item_id")
        .agg(F.max(F.struct("length", "matches")).alias("m"))
        .groupBy("row_no")
        .agg(
            F.count("*").alias("n_items"),
            F.min(F.struct(-F.col("m.length"), F.col("item_id"), F.col("m.matches"))).alias("b"),
        )
        .select("row_no", "n_items", F.col("b.item_id").alias("item_id"), (-F.col("b.col1")).alias("longest"),
                F.col("b.matches").alias("matches"))
    )
    return rows.join(best, "row_no", "left").select(
        "doc_id",
        "text_hash",
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        "item_id",
        F.coalesce("longest", F.lit(0)).alias("longest"),
        F.coalesce("matches", F.lit(0)).alias("matches"),
        F.col("n_items").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows that ``contamination`` marks."""
    bad = contamination(docs, benchmark).where("contaminated").select("doc_id", "text_hash").distinct()
    bad = bad.toDF("_bad_id", "_bad_hash")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_bad_id")) & (
        F.xxhash64(F.col("text").cast("string")) == F.col("_bad_hash")
    )
    return docs.join(bad, same, "left_anti")
