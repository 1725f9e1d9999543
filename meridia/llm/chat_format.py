"""Chat formatting on tokens: segments encoded apart, reserved ids between them, masks from prefix sums.

A turn becomes ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>``, where the marks are ids above the
tokenizer's vocabulary, which no text can produce. Role and text are escaped before encoding: wherever ``<``,
any number of backslashes and ``|`` stand together, one backslash more is put in, so no control string is
left and reading back takes that one away. Turns are encoded where they are read; only ids are shuffled, and
a conversation is laid out by a stream over its sorted turns, so its length is bounded by no task's memory.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed names of the reserved ids, in the order of the ids after the vocabulary's end.
MARKS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
LEARNED_ROLE = "assistant"

_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


class Coder:
    """Encoder and decoder of one vocabulary file (ranks of byte strings, one per line)."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.size = max(ranks.values()) + 1
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.marks = {name: self.size + i for i, name in enumerate(MARKS)}
        self.names = {i: name for name, i in self.marks.items()}

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return self.encoding.decode_bytes(ids).decode("utf-8")


@functools.lru_cache(maxsize=2)
def coder(ranks_path: str, pattern: str) -> Coder:
    return Coder(ranks_path, pattern)


def assemble(segments: list[tuple[list[int], bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of segments laid end to end, and their mask: 1 where a segment is learned.

    The mask is the running sum of +1 at each learned segment's start and -1 at its end.
    """
    sizes = np.array([len(ids) for ids, _ in segments], np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    edges = np.zeros(total + 1, np.int64)
    learned = np.array([flag for _, flag in segments], bool)
    np.add.at(edges, (ends - sizes)[learned], 1)
    np.add.at(edges, ends[learned], -1)
    ids = np.fromiter((i for part, _ in segments for i in part), np.int32, total)
    return ids, np.cumsum(edges)[:total].astype(np.int8)


def _encode_batches(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coder(ranks_path, pattern)
        start, sep, end = ([known.marks[m]] for m in MARKS)
        for batch in batches:
            ids, masks = [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                body = known.encode(escape(text or ""))
                head = known.encode(escape(role or ""))
                made, mask = assemble(
                    [(start, False), (head, False), (sep, False), (body, role == LEARNED_ROLE), (end, False)]
                )
                ids.append(made)
                masks.append(mask)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))],
                names=["conv_id", "turn", "role", "ids", "mask"],
            )

    return run


def _offset_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of each turn in its conversation and of its first token, carried from batch to batch."""
    conv, nth, tokens = object(), 0, 0
    for batch in batches:
        numbers, starts = [], []
        for c, size in zip(batch.column(0).to_pylist(), batch.column(2).value_lengths().to_pylist(), strict=True):
            if c != conv:
                conv, nth, tokens = c, 0, 0
            numbers.append(nth)
            starts.append(tokens)
            nth, tokens = nth + 1, tokens + size
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(numbers, pa.int64()), pa.array(starts, pa.int64()), *batch.columns[2:]],
            names=["conv_id", "turn_no", "token_start", "ids", "mask"],
        )


def format_chat(turns: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Formatted turns: ``conv_id, turn_no, token_start, ids, mask``, each conversation's in order in one partition.

    ``turns``: conv_id, turn, role, text. ``mask`` is 1 on the tokens of an assistant's text. Null texts and
    roles are empty ones; turns with equal numbers stand in the order of role and ids, a null number comes
    first; a null conv_id is a conversation of its own. Other columns are not looked at.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    made = rows.mapInArrow(
        _encode_batches(ranks_path, pattern),
        "conv_id long, turn long, role string, ids array<int>, mask array<tinyint>",
    )
    placed = made.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")
    return placed.select("conv_id", "turn", "ids", "mask").mapInArrow(
        _offset_batches, "conv_id long, turn_no long, token_start long, ids array<int>, mask array<tinyint>"
    )


def conversations(formatted: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, input_ids, loss_mask``; for conversations that fit in a row."""
    parts = F.array_sort(F.collect_list(F.struct("turn_no", "ids", "mask"))).alias("p")
    rows = formatted.groupBy("conv_id").agg(parts)
    return rows.select("conv_id", F.flatten("p.ids").alias("input_ids"), F.flatten("p.mask").alias("loss_mask"))


class _Reader:
    """What is read back from one conversation, token run by token run."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, mask: np.ndarray, known: Coder) -> None:
        start, sep, end = (known.marks[m] for m in MARKS)
        cut = np.flatnonzero(ids >= known.size)
        if [int(ids[i]) for i in cut] != [start, sep, end] or cut[0] != 0 or cut[-1] != len(ids) - 1:
            raise ValueError(f"conversation {self.conv}: a turn is not start, role, separator, text, end")
        role = known.decode(ids[1 : cut[1]].tolist())
        text = known.decode(ids[cut[1] + 1 : -1].tolist())
        self.turns += 1
        self.chars += len(role) + len(text) + sum(map(len, MARKS))
        self.all.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        under = np.flatnonzero(mask)
        if len(under):
            learned = unescape(known.decode(ids[under].tolist()))
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_batches(ranks_path: str, pattern: str):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, reader = coder(ranks_path, pattern), None
        for batch in batches:
            done = []
            ids, masks = batch.column(3), batch.column(4)
            for i, conv in enumerate(batch.column(0).to_pylist()):
                if reader is None or conv != reader.conv:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(conv)
                reader.add(ids[i].values.to_numpy(), masks[i].values.to_numpy(), known)
            if done:
                yield table(done)
        if reader is not None:
            yield table([reader.row()])

    return run


def read_back(formatted: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of what ``format_chat`` wrote, from its tokens and masks alone, one row per conversation.

    Reads the operator's own partitions in their order, so it must follow it directly.
    """
    return formatted.mapInArrow(
        _read_batches(ranks_path, pattern),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
