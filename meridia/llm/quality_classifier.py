"""Supervised subword embeddings: hashed word and character n-gram vectors, averaged, then softmax.

A text becomes two averages: of the vectors of its words and neighbouring word pairs, and of its character
runs of three and four. Both are learned together with the softmax output by plain stochastic gradient
descent in numpy. As the output is linear in the averages, scoring needs one number per hashed n-gram:
the difference between both classes' outputs for its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.llm.folds import held_out, sample_per_class
from meridia.llm.words import chunks, mix, split
from meridia.session import materialize

BUCKETS = 1 << 17
DIMENSIONS = 8
# The bound of the training sample: whole texts, so many of each label.
PER_LABEL = 1200
EPOCHS, RATE = 6, 0.6
_MASK = np.uint64(BUCKETS - 1)
# A pair of one word twice says the same whatever the word, so all such pairs share a vector.
_TWICE = np.uint64(1)


@dataclass
class Model:
    """``vectors``: of buckets; ``output``: two averages by two classes; ``bias``; ``known``: both labels seen."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    known: bool


Group = tuple[np.ndarray, np.ndarray, np.ndarray]


def ngrams(texts: list[str]) -> Iterator[tuple[list[Group], list[Group]]]:
    """For every chunk of texts the groups of word and of character n-grams.

    A group has the buckets of all its n-grams in order, and each text's first one and end.
    """
    for lo, hi in chunks(texts):
        words = split(texts[lo:hi], lower=False)
        hashes, first, end = words.hashes, words.bounds[:-1], words.bounds[1:]
        pair = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
        pair[hashes[:-1] == hashes[1:]] = _TWICE
        # Runs may take in the line end after a text, not its neighbour.
        codes, start, stop = mix(words.codes.astype(np.uint64)), words.offsets[:-1], words.offsets[1:]
        three = mix(codes[:-2] + codes[1:-1] * np.uint64(5) + codes[2:] * np.uint64(25))
        four = mix(three[:-1] * np.uint64(7) + codes[3:])
        yield (
            [_group(hashes, first, end), _group(pair, first, end - 1)],
            [_group(three, start, stop - 2), _group(four, start, stop - 3)],
        )


def _group(hashes: np.ndarray, first: np.ndarray, end: np.ndarray) -> Group:
    return (hashes & _MASK).astype(np.int32), np.minimum(first, len(hashes)), np.clip(end, first, None).clip(0, len(hashes))


def _bags(texts: list[str]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For each text two bags, of words and of runs: distinct buckets with their shares."""
    out = []
    for groups in ngrams(texts):
        for i in range(len(groups[0][0][1])):
            bags = []
            for group in groups:
                found = np.concatenate([grams[first[i] : end[i]] for grams, first, end in group])
                ids, n = np.unique(found, return_counts=True)
                bags.append((ids, (n / max(n.sum(), 1)).astype(np.float32)))
            out.append(bags)
    return out


def train(texts: list[str], labels: list[int], seed: int = 5) -> Model:
    """Learn from whole texts with labels 0 and 1; without both labels nothing is known."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((2 * DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    if len(set(labels)) < 2:
        return Model(vectors, output, bias, False)
    output += rng.normal(0, 0.1, output.shape).astype(np.float32)
    bags = _bags(texts)
    y = np.asarray(labels)
    weight = len(y) / (2 * np.bincount(y, minlength=2))[y]
    total, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            rate = RATE * (1 - done / total)
            done += 1
            halves = [share @ vectors[ids] if len(ids) else np.zeros(DIMENSIONS, np.float32) for ids, share in bags[i]]
            hidden = np.concatenate(halves)
            z = hidden @ output + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= min(weight[i], 4.0)
            back = output @ p
            output -= rate * np.outer(hidden, p)
            bias -= rate * p
            for (ids, share), g in zip(bags[i], (back[:DIMENSIONS], back[DIMENSIONS:]), strict=True):
                vectors[ids] -= rate * share[:, None] * g[None] * len(ids) ** 0.5
    return Model(vectors, output, bias, True)


def score_texts(texts: list[str], model: Model) -> Iterator[float]:
    """Probability of label 1 for each text."""
    if not model.known:
        yield from [0.5] * len(texts)
        return
    side = (model.output[:, 1] - model.output[:, 0]).astype(np.float64)
    of_words = (model.vectors @ side[:DIMENSIONS]).astype(np.float64)
    of_runs = (model.vectors @ side[DIMENSIONS:]).astype(np.float64)
    shift = float(model.bias[1] - model.bias[0])
    for groups in ngrams(texts):
        z = np.full(len(groups[0][0][1]), shift)
        for weights, group in zip((of_words, of_runs), groups, strict=True):
            total, count = np.zeros(len(z)), np.zeros(len(z))
            for grams, first, end in group:
                sums = np.concatenate([[0.0], np.cumsum(weights[grams])])
                total += sums[end] - sums[first]
                count += end - first
            z += total / np.maximum(count, 1)
        yield from 1 / (1 + np.exp(-z))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Learn from texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) marks, outside the held-out fold.

    The sample is bounded: ``per_label`` whole texts of each label. An id marked both ways is not used, a null
    label or id neither; a null text is an empty one. Of rows that share an id one is learned from, that with the
    smallest hash.
    """
    marks = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IN (0, 1)")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    # Marks without a text would only leave the sample smaller.
    marks = marks.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = materialize(sample_per_class(marks, "label", "doc_id", per_label), "chosen")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    # The sample is bounded by its parameter, so its ids may be sent to every scan.
    # Of rows that share an id, one counts: a hot id must not bring a third of all texts to the driver.
    rows = docs.select("doc_id", text).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text"))
    rows = rows.orderBy("label", "doc_id").collect()
    return train([r.text for r in rows], [r.label for r in rows])


def score(docs: DataFrame, model: Model, cut: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (doc_id, text).

    ``score`` is the probability of label 1; null and empty texts get that of no n-gram at all, a model
    without both labels gives 0.5. ``predicted`` is 1 from ``cut`` on. Other columns are not looked at.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            made = pa.array(list(score_texts(texts, known.value)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], made], names=["doc_id", "held_out", "score"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    )
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0))
