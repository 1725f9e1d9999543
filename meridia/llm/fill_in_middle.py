"""Fill-in-middle: texts cut at two random unit ranks and laid out around markers.

A unit is a word with the white space before it, or white space at the end of a text. Cut ranks count units,
texts are cut by code points: an indexable skip list over the units turns one into the other. Every lane's
links carry the number of units and of code points they pass; a search runs along the sparsest lane while the
units passed stay within the rank, drops a lane, and has the cut's code point when the rank is reached.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridia.llm.words import mix

# Fixed strings of the two layouts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# One node in this many of a lane stands on the next one too.
LANE_STEP_BITS = 2


def unit_ends(text: str) -> np.ndarray:
    """Code point at which every unit ends."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.int64)
    white = (codes == 32) | (codes - np.uint32(9) < 5)
    return np.append(np.flatnonzero(white[1:] & ~white[:-1]) + 1, len(codes))


@dataclass
class _Lane:
    """Links of one lane, in order: units and code points each passes, and where its start stands one lane below."""

    units: list[int]
    chars: list[int]
    below: list[int]


class SkipList:
    """Indexable skip list over units: rank of a cut to its code point in expected logarithmic time.

    Nodes are the cuts 0 to n. How many lanes a node stands on comes from a hash of its rank, so a list
    is the same on every run; node 0 stands on all of them.
    """

    def __init__(self, ends: np.ndarray) -> None:
        self.n = len(ends)
        chars = np.zeros(self.n + 1, np.int64)
        chars[1:] = ends
        nodes = np.arange(self.n + 1)
        spread = mix(nodes.astype(np.uint64))
        self.lanes: list[_Lane] = []
        below = nodes
        while True:
            at = np.searchsorted(below, nodes)
            self.lanes.append(_Lane(np.diff(nodes).tolist(), np.diff(chars[nodes]).tolist(), at.tolist()))
            low = np.uint64((1 << LANE_STEP_BITS * len(self.lanes)) - 1)
            higher = nodes[(nodes == 0) | (spread[nodes] & low == 0)]
            if len(higher) == 1:
                break
            below, nodes = nodes, higher

    def code_point(self, rank: int) -> int:
        """Where the unit of this rank ends; 0 for rank 0."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        at = units = chars = 0
        for lane in reversed(self.lanes):
            while at < len(lane.units) and units + lane.units[at] <= rank:
                units += lane.units[at]
                chars += lane.chars[at]
                at += 1
            at = lane.below[at]
        return chars


def draws(seed: str, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers drawn for a document; a null id draws as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def lay_out(text: str, doc_id: int | None, seed: str, rate: int, spm_rate: int) -> tuple:
    """Units, form, code points of prefix and middle, and the text laid out."""
    ends = unit_ends(text)
    first, second, formed, order = draws(seed, doc_id)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or formed % 100 >= rate:
        return len(ends), "plain", None, None, text
    units = SkipList(ends)
    a, b = sorted((first % (units.n + 1), second % (units.n + 1)))
    start, stop = units.code_point(a), units.code_point(b)
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    if order % 100 < spm_rate:
        return units.n, "spm", start, stop - start, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units.n, "psm", start, stop - start, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


_NAMES = ["n", "form", "prefix_chars", "middle_chars", "output"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string()]


def fill_in_middle(
    docs: DataFrame, seed: str = "42", rate: int = 50, spm_rate: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document laid out: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``rate`` percent of the documents are laid out, ``spm_rate`` percent of these with the suffix first; a text
    that is empty or holds a marker stays plain, with null counts of characters. Draws depend on seed and id
    alone, so repeated rows come out alike and equal ids are cut at equal draws. A null text is an empty one,
    a null id draws as an empty id. A text of any length is one row. Other columns are not looked at; an empty
    table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            made = [lay_out(t, i, seed, rate, spm_rate) for i, t in zip(ids, texts, strict=True)]
            columns = list(zip(*made, strict=True)) or [()] * len(_NAMES)
            arrays = [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *_NAMES])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    return rows.mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The original text from a laid-out one; the markers stand once each, as laid-out texts hold none."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    prefix, suffix = F.when(form == "psm", parts[1]).otherwise(parts[2]), F.when(form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))
