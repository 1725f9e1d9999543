"""Token counts of texts of any length, as a tokenizer file's own library gives them for the whole text.

A text longer than a chunk is encoded in overlapping chunks, each a row of its own, so that a huge document is
spread over tasks. In an overlap two encodings are spliced at the first place where both start a pretoken:
the splitting pattern looks forward only, so from there on the later chunk is split as the whole text is, while
the earlier one is right up to its last few characters. Where an overlap has no such place, that text is encoded
again with a wider overlap, up to the whole text at once.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.session import materialize

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 8
WIDENING = 8

# Copies of one long text are spread over this many groups when they get their count.
SALTS = 64

# Characters of a worker's output batch; distinct strings whose counts a worker remembers, and their length.
BATCH_CHARS = 1 << 23
REMEMBERED, REMEMBERED_CHARS = 1 << 18, 48

# Before a space or newline that follows a character which no Unicode version takes for white space: there
# every pretoken ends, since none has white space after its first other character.
_SAFE_CUT = re.compile(r"(?<=[^\s\u180e])(?=[ \n])")


class Counter:
    """Counts and boundaries of one tokenizer file (byte-level BPE, no normalizer, pattern without look-behind)."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, processors

        self.library = Tokenizer.from_file(path)
        # Offsets of whole pretokens; ids stay as they are.
        self.library.post_processor = processors.ByteLevel(trim_offsets=False)
        special = [len(t.content) for t in self.library.get_added_tokens_decoder().values()]
        # A special string cut off by a chunk's end may be split wrongly there, and so may the white space before it.
        self.unsure = max(special, default=0) + 2
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, encoded between safe cuts; equal strings between cuts are encoded once."""
        cut = [_SAFE_CUT.split(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({part for parts in cut for part in parts if part not in known})
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            made = self.library.encode_batch_fast(some, add_special_tokens=False)
            known.update(zip(some, map(len, made), strict=True))
        out = [sum(map(known.__getitem__, parts)) for parts in cut]
        for part in new:
            if len(part) > REMEMBERED_CHARS:
                del known[part]
        return out

    def boundaries(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Tokens of a chunk, the code points where a pretoken starts, and the tokens before each of them."""
        made = self.library.encode(text, add_special_tokens=False)
        pretoken = np.array(made.word_ids, np.int64)
        first = np.flatnonzero(np.diff(pretoken, prepend=-1) != 0)
        offsets = made.offsets
        starts = np.array([offsets[i][0] for i in first], np.int64)
        return len(pretoken), starts, first


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def _count_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            counts = known.counts(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return run


def _cut_batches(chunk: int, overlap: int):
    """Rows (digest, chunk_no, last, body) of the overlapping chunks of each text."""
    names = ["digest", "chunk_no", "last", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for no, start in enumerate(range(0, len(text), chunk)):
                    body = text[start : start + chunk + overlap]
                    last = start + chunk >= len(text)
                    rows.append((digest, no, last, body))
                    size += len(body)
                    if size >= BATCH_CHARS:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)

    return run


_CHUNK_ROWS = "digest string, chunk_no long, last boolean, n long, {}".format(
    ", ".join(f"{side} array<struct<at:long,n:long>>" for side in ("head", "tail"))
)


def _encode_batches(path: str, chunk: int, overlap: int):
    """Tokens of each chunk; boundaries in its first overlap with the tokens before them (``head``), and in the one
    it shares with the next chunk with the tokens from them on (``tail``). ``at`` counts from the overlap's start."""
    pairs = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))

    def listed(at: np.ndarray, n: np.ndarray) -> list[dict]:
        return [{"at": a, "n": b} for a, b in zip(at.tolist(), n.tolist(), strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            counts, heads, tails = [], [], []
            for no, last, body in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                n, starts, before = known.boundaries(body)
                counts.append(n)
                head = starts < overlap if no else np.zeros(len(starts), bool)
                heads.append(listed(starts[head], before[head]))
                sure = (starts >= chunk) & (starts <= len(body) - known.unsure) & (not last)
                tails.append(listed(starts[sure] - chunk, n - before[sure]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(heads, pairs), pa.array(tails, pairs)],
                names=["digest", "chunk_no", "last", "n", "head", "tail"],
            )

    return run


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``digest, n_tokens`` of distinct texts; null where an overlap has no common boundary.

    Chunks of equal texts are merged before and in the one shuffle that spreads them.
    """
    cut = texts.mapInArrow(_cut_batches(chunk, overlap), "digest string, chunk_no long, last boolean, body string")
    chunks = materialize(
        cut.dropDuplicates(["digest", "chunk_no"]).mapInArrow(_encode_batches(path, chunk, overlap), _CHUNK_ROWS),
        "token-chunks",
    )
    left = chunks.select("digest", (F.col("chunk_no") + 1).alias("no"), F.inline("tail").alias("at", "from_on"))
    right = chunks.select("digest", F.col("chunk_no").alias("no"), F.inline("head").alias("at", "before"))
    joints = left.join(right, ["digest", "no", "at"]).groupBy("digest", "no")
    twice = joints.agg(F.min(F.struct("at", (F.col("from_on") + F.col("before")).alias("n"))).alias("first"))
    parts = chunks.select("digest", F.col("n"), F.lit(1).alias("open")).unionByName(
        twice.select("digest", (-F.col("first.n")).alias("n"), F.lit(-1).alias("open"))
    )
    sums = parts.groupBy("digest").agg(F.sum("n").alias("n"), F.sum("open").alias("open"))
    return sums.select("digest", F.when(F.col("open") == 1, F.col("n")).alias("n_tokens"))


def _long_counts(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    done, left = None, texts
    while True:
        made = materialize(_spliced(left, path, chunk, overlap), "token-sums")
        good = made.where(F.col("n_tokens").isNotNull())
        done = good if done is None else done.unionByName(good)
        failed = made.where(F.col("n_tokens").isNull()).select("digest")
        if failed.isEmpty():
            return done
        left = texts.join(failed, "digest", "left_semi")
        overlap *= WIDENING
        chunk = max(chunk, overlap)


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int = 1024,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document, one row for each.

    ``path``: a byte-level BPE file of the ``tokenizers`` library, present on every machine. Special strings in a
    text count as that library counts them by default. ``chunk`` only decides what is encoded in one piece,
    never a count. A null text is an empty one with no tokens; equal rows give equal rows; null ids stay.
    Other columns are not looked at; an empty table gives an empty one.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("an overlap is longer than 0 and no longer than a chunk")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    size = F.octet_length("text").cast("long").alias("n_bytes")
    is_long = F.length("text") > chunk
    short = rows.where(~is_long).select("doc_id", size, "text")
    counted = short.mapInArrow(_count_batches(path), "doc_id long, n_bytes long, n_tokens long")
    digest = F.sha2("text", 256).alias("digest")
    long = rows.where(is_long)
    totals = _long_counts(long.select(digest, "text"), path, chunk, overlap)
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")
    met = long.select("doc_id", size, digest, salt).join(salted, ["digest", "salt"], "left")
    whole = counted.unionByName(met.select("doc_id", "n_bytes", "n_tokens"))
    return whole.withColumn("over_limit", F.col("n_tokens") > limit)
