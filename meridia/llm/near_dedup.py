"""Near-duplicate documents by HyperMinHash: compressed registers, banding, corrected estimate, exact check.

Every distinct shingle falls into one of ``BUCKETS`` buckets by eight bits of its hash; a bucket keeps the
leading-zero count of the smallest remaining hash and the ten bits after it (two bytes per bucket). For
banding, an empty bucket borrows from the first filled one in an order fixed per bucket, so short texts
agree as often as long ones. Bands of ``BAND_ROWS`` registers become candidates; the share of equal
registers, less the chance collisions expected of so few bits, sorts out the clearly different; what is left
is compared on full sets.

Texts with equal sets are one class and take part once. In a band, every class is first compared with the
smallest of the band, so a band of thousands of near copies costs thousands of comparisons. What that leaves
open (two classes of one band in different components) is compared inside sorted batches, in blocks of bounded
size: first by short sketches, then by the sets in 32 bits a shingle, of large sets a sample. Only pairs that
come out as links there, and join components, leave the batch: families of similar texts make few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridia.llm.components import components
from meridia.llm.words import chunks, joined, mix, split
from meridia.session import materialize

BUCKETS = 256
MANTISSA = 10
# At similarity 0.8 a pair shares no band with probability (1 - 0.8**6)**42, under 3 in a million.
BANDS, BAND_ROWS = 42, 6
# A candidate is dropped on an estimate only this many standard errors below the threshold.
SLACK = 5.0
# One byte of this many borrowed-in registers: a sketch that travels with the bands.
SKETCH = 128
BLOCK = 512
# Sets up to this size travel whole, in 32 bits a shingle; larger ones as a sample of about half to all of it.
WHOLE = 1024

_REST = np.uint64((1 << 56) - 1)
_M = np.uint64(0xD6E8FEB86659FD93)


def _probe_orders() -> np.ndarray:
    """For every bucket the order in which an empty one looks for a filled one."""
    grid = np.arange(BUCKETS * BUCKETS, dtype=np.uint64).reshape(BUCKETS, BUCKETS)
    return np.argsort(mix(grid + np.uint64(1)), axis=1)


PROBES = _probe_orders()


def registers(distinct: np.ndarray) -> np.ndarray:
    """Registers of one sorted set of hashes: 0 when empty, else (leading zeros + 1) and mantissa bits."""
    out = np.zeros(BUCKETS, np.uint16)
    if len(distinct):
        bucket = (distinct >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        # 52 of the remaining bits: exact as floats, whose exponent counts the zeros.
        value = (distinct[first] & _REST) >> np.uint64(4)
        zeros = 52 - np.frexp(value.astype(np.float64))[1]
        shifted = (value << (zeros + 1).astype(np.uint64)) & np.uint64((1 << 52) - 1)
        mantissa = shifted >> np.uint64(52 - MANTISSA)
        out[bucket[first]] = ((zeros + 1).astype(np.uint64) << np.uint64(MANTISSA)) | mantissa
    return out


def band_keys(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all bands, and sketches, for rows of registers; rows without a filled bucket must be left out."""
    full = regs.astype(np.int64)
    source = np.tile(np.arange(BUCKETS), (len(regs), 1))
    row, col = np.nonzero(regs == 0)
    for step in range(BUCKETS):
        if not len(row):
            break
        near = PROBES[col, step]
        found = regs[row, near]
        hit = found != 0
        full[row[hit], col[hit]], source[row[hit], col[hit]] = found[hit], near[hit]
        row, col = row[~hit], col[~hit]
    value = (full | (source << 16)).astype(np.uint64)
    sketch = mix(value[:, :SKETCH]).astype(np.uint8)
    value = value[:, : BANDS * BAND_ROWS].reshape(len(regs), BANDS, BAND_ROWS)
    key = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(regs), 1))
    for j in range(BAND_ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + value[:, :, j])
    return key.view(np.int64), sketch


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of pairs of register rows without expected chance collisions, and the buckets it rests on."""
    filled = ((a != 0) | (b != 0)).sum(axis=1)
    equal = ((a == b) & (a != 0)).sum(axis=1)
    large, small = np.maximum(n_a, n_b).astype(float), np.minimum(n_a, n_b).astype(float)
    # Two unrelated minima agree in zeros and mantissa with about 2**-MANTISSA times this, for filled buckets.
    ratio = 4 * (large / np.maximum(small, 1)) / (1 + large / np.maximum(small, 1)) ** 2
    chance = 0.169919487159739 * ratio * 2.0 ** (8 - MANTISSA) * np.minimum(1, small / BUCKETS)
    return np.clip((equal - chance) / np.maximum(filled, 1), 0, 1), filled


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``width`` words; of its whole sequence if it has fewer."""
    for lo, hi in chunks(texts):
        words = split(texts[lo:hi])
        hashes, bounds = words.hashes, words.bounds
        runs = joined(hashes, width)
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if e - s >= width:
                found = np.sort(runs[s : e - width + 1])
                yield found[np.concatenate([[True], found[1:] != found[:-1]])]
            else:
                whole = joined(hashes[s:e], e - s) if e > s else hashes[:0]
                yield mix(whole + np.uint64(e - s))


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _signature_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            size, one, two, regs = [], [], [], []
            for s in shingle_sets(texts, width):
                size.append(len(s))
                one.append(int(_signed(np.add.reduce(mix(s + np.uint64(1)), keepdims=True))[0]) if len(s) else 0)
                two.append(int(_signed(np.add.reduce(mix(s ^ _M), keepdims=True))[0]) if len(s) else 0)
                regs.append(registers(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.array(regs, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "registers"],
            )

    return run



def _as_registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            keys, _ = band_keys(_as_registers(part.column(1)))
            rep = np.repeat(part.column(0).to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(rep)], names=["band", "rep"])


def digest(distinct: np.ndarray) -> np.ndarray:
    """A set in 32 bits a shingle, sorted; of a set above ``WHOLE`` the values up to a limit."""
    short = np.unique((distinct >> np.uint64(16)).astype(np.uint32))
    return short[short <= _sample_limit(len(distinct))]


def _sample_limit(n: int) -> int:
    """Sampled are the 32-bit values up to this one; halved whenever a set's size doubles beyond ``WHOLE``."""
    return ((1 << 32) >> max(0, (int(n) - 1).bit_length() - WHOLE.bit_length() + 1)) - 1


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests and sketches of the classes' sets."""
    for batch in batches:
        sets = [s.values.to_numpy().view(np.uint64) for s in batch.column(1)]
        regs = np.stack([registers(s) for s in sets]) if sets else np.zeros((0, BUCKETS), np.uint16)
        _, sketch = band_keys(regs)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([r.tobytes() for r in sketch], pa.binary()),
             pa.array([digest(s).tobytes() for s in sets], pa.binary())],
            names=["rep", "n_shingles", "sketch", "digest"],
        )


def close_pairs(
    sketch: np.ndarray, size: np.ndarray, component: np.ndarray, side: np.ndarray, digests: list[bytes],
    threshold: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows in different components whose sizes, sketches and digests allow the threshold.

    ``side`` tells two blocks apart: rows of one side are compared with the other's, or all with all if there
    is one side only. Pairs of whole digests are links, so they join their components here and further pairs
    of the two say no more; a family of true copies gives a pair per copy. Of sampled sets every pair that
    may be a link is given.
    """
    least = (threshold - SLACK * (threshold * (1 - threshold) / SKETCH) ** 0.5) * SKETCH
    component, found = component.copy(), []
    both = len(side) and side.min() != side.max()
    values = [np.frombuffer(d, np.uint32) for d in digests]
    for i in range(len(sketch) - 1):
        rest = slice(i + 1, None)
        ok = component[rest] != component[i]
        ok &= np.minimum(size[rest], size[i]) >= threshold * np.maximum(size[rest], size[i]) - 1e-9
        if both:
            ok &= side[rest] != side[i]
        at = np.flatnonzero(ok) + i + 1
        if len(at):
            at = at[(sketch[at] == sketch[i]).sum(1) >= least]
        whole = at[(size[at] <= WHOLE) & (size[i] <= WHOLE)]
        if len(whole):
            cuts = np.concatenate([[0], np.cumsum([len(values[j]) for j in whole])[:-1]])
            theirs = np.concatenate([values[j] for j in whole])
            place = np.minimum(np.searchsorted(values[i], theirs), len(values[i]) - 1)
            common = np.add.reduceat((values[i][place] == theirs).astype(np.int64), cuts)
            for j in whole[common >= threshold / (1 + threshold) * (size[i] + size[whole]) - 1e-9]:
                if component[j] != component[i]:
                    found.append((i, j))
                    component[component == component[j]] = component[i]
        for j in at[(size[at] > WHOLE) | (size[i] > WHOLE)]:
            if component[j] != component[i] and _sampled_close(values[i], values[j], size[i], size[j], threshold):
                found.append((i, j))
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return a, b


def _sampled_close(one: np.ndarray, two: np.ndarray, n_one: int, n_two: int, threshold: float) -> bool:
    limit = min(_sample_limit(n_one), _sample_limit(n_two))
    one, two = one[one <= limit], two[two <= limit]
    common = len(np.intersect1d(one, two, assume_unique=True))
    union = max(len(one) + len(two) - common, 1)
    return common / union >= threshold - SLACK * (threshold * (1 - threshold) / union) ** 0.5


def _close_batches(threshold: float):
    """Close pairs of every run of rows with one key; rows come sorted by it, a run is a block or two."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        key = np.stack([table.column(c).to_numpy() for c in ("band", "p", "q")], axis=1)
        cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1), [True]]))
        rep, size, component, side = (table.column(c).to_numpy() for c in ("rep", "n_shingles", "component", "side"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
        digests = table.column("digest").to_pylist()
        out = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            part = slice(lo, hi)
            a, b = close_pairs(sketch[part], size[part], component[part], side[part], digests[part], threshold)
            out.append(np.stack([rep[lo + a], rep[lo + b]]))
        ends = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        ends = np.unique(np.sort(ends, axis=0), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(ends[0], pa.int64()), pa.array(ends[1], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last key of a batch may go on in the next one.
            table = pa.Table.from_batches([*held, batch])
            key = np.stack([table.column(c).to_numpy() for c in ("band", "p", "q")], axis=1)
            last = int(np.argmax((key == key[-1]).all(1)))
            if last:
                yield pairs(table.slice(0, last))
            held = table.slice(last).to_batches()
        if held:
            yield pairs(pa.Table.from_batches(held))

    return run


def _estimate_batches(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = [batch.column(i).to_numpy() for i in (4, 5)]
            value, filled = estimate(_as_registers(batch.column(2)), _as_registers(batch.column(3)), *sizes)
            # Of small sets the filled buckets show nearly all, so little is left to chance.
            shown = np.minimum(filled / ((sizes[0] + sizes[1]) / (1 + threshold)), 1)
            error = np.sqrt(threshold * (1 - threshold) / np.maximum(filled, 1) * (1.05 - shown))
            near = value >= threshold - SLACK * error - 1 / np.maximum(filled, 1)
            near &= np.minimum(*sizes) >= threshold * np.maximum(*sizes) - 1e-9
            yield batch.select([0, 1]).filter(pa.array(near))

    return run


def _set_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            lists = pa.array([_signed(s) for s in shingle_sets(texts, width)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["rep", "shingles"])

    return run


def signatures(docs: DataFrame, width: int = 5) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): set size, two sums that name the set, registers."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(
        _signature_batches(width),
        "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, registers binary",
    )


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """Component of every row of ``docs`` (doc_id, text).

    Columns ``doc_id, text_hash, n_shingles, component_id, kept``.

    Words lose the case of A-Z; a text's set holds its distinct runs of ``width`` words, or its whole word
    sequence if it has fewer. Two texts are linked when their sets' Jaccard similarity is ``threshold`` or
    more. ``component_id`` is the smallest doc_id reachable over links, ``kept`` says whether the row is that
    one. Texts that are null, empty or without words
    have no set and are linked with nothing. A null doc_id can't be linked: its component is null, and it is
    kept. Rows that share a doc_id count each with its own text; equal rows get equal results. Other columns
    are not looked at. An empty table gives an empty result.
    """
    signed = materialize(signatures(docs, width), "signatures")
    of_set = ["set_a", "set_b", "n_shingles"]
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    usable = usable.drop("text_hash")
    first = F.row_number().over(Window.partitionBy(*of_set).orderBy("doc_id"))
    classes = usable.withColumn("_rank", first).where("_rank = 1").drop("_rank").withColumnRenamed("doc_id", "rep")
    classes = materialize(classes, "classes")
    bands = classes.select("rep", "registers").mapInArrow(_band_batches, "band long, rep long")
    groups = bands.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub <> top")
    shared = materialize(
        bands.distinct().join(groups.drop("top"), "band").select("band", "rep", "hub"), "bands"
    )  # classes that share a band
    sets = _sets(docs, classes, shared, width)
    stars = shared.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    links = materialize(_verified(stars, classes, sets, threshold), "near-links")
    joined_up = components(links)
    rest = materialize(
        _verified(_open_pairs(shared, sets, joined_up, threshold), classes, sets, threshold), "near-links"
    )
    if not rest.isEmpty():
        links = links.unionByName(rest).distinct()
        joined_up = components(links)
    named = (
        classes.select(*of_set, "rep")
        .join(joined_up.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*of_set, F.coalesce("component", "rep").alias("component"))
    )
    out = signed.drop("registers").join(named, of_set, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _sets(docs: DataFrame, classes: DataFrame, shared: DataFrame, width: int) -> DataFrame:
    """Full sets of the classes that share a band, one row each."""
    wanted = shared.select("rep").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    sets = rows.join(wanted, "rep", "left_semi").mapInArrow(_set_batches(width), "rep long, shingles array<long>")
    return materialize(sets.where(F.size("shingles") > 0), "sets")


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough, each once."""
    r = classes.select("rep", "registers", "n_shingles")
    near = (
        pairs.distinct()
        .join(r.toDF("a", "ra", "na"), "a")
        .join(r.toDF("b", "rb", "nb"), "b")
        .select("a", "b", "ra", "rb", "na", "nb")
        .mapInArrow(_estimate_batches(threshold), "a long, b long")
    )
    both = near.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    per_cent = round(threshold * 100)
    union = F.size("sa").cast("long") + F.size("sb") - common
    return both.where(common * 100 >= union * per_cent).select("a", "b").distinct()


def _open_pairs(shared: DataFrame, sets: DataFrame, done: DataFrame, threshold: float) -> DataFrame:
    """Pairs that stars leave open: close classes of one band in different components.

    A band of more than ``BLOCK`` classes is dealt into blocks, and every two blocks meet apart, so no task
    holds more than two blocks of one band, whatever its size.
    """
    named = shared.join(done.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = (
        named.groupBy("band")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
        .where("lo <> hi")
        .select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    sketches = sets.mapInArrow(
        _digest_batches, "rep long, n_shingles long, sketch binary, digest binary"
    )
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    rows = named.join(mixed, "band").withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "band", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "rep", "component",
        F.col("own").alias("side"),
    )
    keyed = rows.join(sketches, "rep").select("band", "p", "q", "rep", "component", "side", "n_shingles", "sketch", "digest")
    keyed = keyed.repartition("band", "p", "q").sortWithinPartitions("band", "p", "q")
    return keyed.mapInArrow(_close_batches(threshold), "a long, b long").distinct()


def keep_one(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs``, all columns, with one row of every component: that with the smallest doc_id.

    Of rows that share doc_id and text one stays. Rows without a set or without a doc_id all stay but for such
    repeats.
    """
    name = F.coalesce(F.concat(F.lit("d"), F.col("doc_id").cast("long").cast("string")), F.lit(""))
    kept = near_duplicates(docs, width, threshold).where("kept").select(name.alias("_name"), F.col("text_hash").alias("_hash"))
    rows = docs.withColumn("_name", name).withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    rows = rows.join(kept.distinct(), ["_name", "_hash"], "left_semi").dropDuplicates(["_name", "_hash"])
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))
