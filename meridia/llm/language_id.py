"""Language of every word of code-switched text by a linear-chain conditional random field.

A word's features are itself, its affixes of one to three characters, its character bigrams and trigrams,
and the lexicons it stands in; features are hashed into a fixed table of weights. Weights and transitions
between neighbouring words' languages are learned by stochastic gradient steps on spliced runs of words
from texts of different languages, whose true switches are thus known. Forward-backward gives each word's
probabilities; a text's language is the one with the largest sum over its words with a letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.llm.folds import held_out, sample_per_class
from meridia.llm.words import Words, chunks, mix, split

BUCKETS = 1 << 16
# The bound of the training sample: whole texts, so many per language.
PER_LANGUAGE = 300
SEQUENCES, STEPS, SWITCH = 6000, 32, 0.03
EPOCHS, BATCH, RATE, DECAY = 4, 200, 0.25, 1e-6
BLOCK = 32

_alphabetic: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _alphabetic
    if _alphabetic is None:
        _alphabetic = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _alphabetic


@dataclass
class Model:
    """``weights``: features by languages; ``transitions``; ``lexicon``: sorted word hashes and their language."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: np.ndarray
    lexicon_language: np.ndarray


def word_features(
    words: Words, pick: np.ndarray, hashes: np.ndarray, lexicon: np.ndarray, lexicon_language: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in ``pick``, feature) of the picked words."""
    starts, ends = words.starts[pick], words.ends[pick]
    rows, found = [np.arange(len(pick))], [mix(hashes[pick] + np.uint64(11))]
    for k in (1, 2, 3):
        for kind, (lo, hi) in enumerate(
            ((starts, np.minimum(starts + k, ends)), (np.maximum(ends - k, starts), ends))
        ):
            rows.append(rows[0])
            found.append(mix(words.span_hashes(lo, hi) + np.uint64(20 + 2 * k + kind)))
    size = ends - starts
    for n in (2, 3):
        count = np.maximum(size - n + 1, 0)
        row = np.repeat(rows[0], count)
        first = np.repeat(starts - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        rows.append(row)
        found.append(mix(words.span_hashes(first, first + n) + np.uint64(40 + n)))
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, hashes[pick]), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[at] == hashes[pick])
        rows.append(known)
        found.append(mix(lexicon_language[at[known]].astype(np.uint64) + np.uint64(50)))
    return np.concatenate(rows), (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _scores(rows: np.ndarray, features: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    return np.stack(
        [np.bincount(rows, weights[features, k], minlength=n) for k in range(weights.shape[1])], axis=1
    )


def _chain(potentials: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all steps, and summed marginals of neighbouring pairs, for (sequence, step, label)."""
    n, steps, labels = potentials.shape
    alpha, beta = np.empty_like(potentials), np.ones_like(potentials)
    alpha[:, 0] = potentials[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        a = (alpha[:, t - 1] @ passage) * potentials[:, t]
        alpha[:, t] = a / a.sum(1, keepdims=True)
    pairs = np.zeros((labels, labels))
    for t in range(steps - 2, -1, -1):
        ahead = potentials[:, t + 1] * beta[:, t + 1]
        b = ahead @ passage.T
        beta[:, t] = b / b.sum(1, keepdims=True)
        joint = alpha[:, t, :, None] * passage[None] * ahead[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    marginals = alpha * beta
    return marginals / marginals.sum(2, keepdims=True), pairs


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Learn from whole texts of known language; no text gives a model without languages."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    k = len(languages)
    words = split([t.lower() for t in texts])
    hashes = words.hashes
    unique, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    of_text = np.array([languages.index(x) for x in labels])
    of_word = of_text[words.text_of_word]
    counts = np.zeros((len(unique), k))
    np.add.at(counts, (word, of_word), 1)
    sure = (counts.sum(1) >= 3) & (counts.max(1) >= 0.9 * counts.sum(1))
    lexicon, lexicon_language = unique[sure], counts[sure].argmax(1)
    rng = np.random.default_rng(seed)
    usable = [
        [(s, e) for s, e, x in zip(words.bounds[:-1], words.bounds[1:], of_text, strict=True) if x == c and e > s]
        for c in range(k)
    ]
    present = [c for c in range(k) if usable[c]]
    weights, transitions = np.zeros((BUCKETS, k)), np.zeros((k, k))
    if not present:
        return Model(languages, weights, transitions, lexicon, lexicon_language)
    steps = np.empty((SEQUENCES, STEPS), np.int64)
    gold = np.empty((SEQUENCES, STEPS), np.int64)
    for i in range(SEQUENCES):
        filled = 0
        while filled < STEPS:
            c = present[rng.integers(len(present))]
            s, e = usable[c][rng.integers(len(usable[c]))]
            run = min(int(rng.geometric(SWITCH)), STEPS - filled, e - s)
            at = s + rng.integers(e - s - run + 1)
            steps[i, filled : filled + run], gold[i, filled : filled + run] = word[at : at + run], c
            filled += run
    # Features of the words that are learned from, word by word: a step looks at its own words only.
    used, steps = np.unique(steps, return_inverse=True)
    steps = steps.reshape(SEQUENCES, STEPS)
    rows, features = word_features(words, first[used], hashes, lexicon, lexicon_language)
    features = features[np.argsort(rows, kind="stable")].astype(np.int32)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(used)))])
    del words, hashes, unique, first, word, of_word, counts, rows
    grown, grown_t = np.full_like(weights, 1e-3), np.full_like(transitions, 1e-3)
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(SEQUENCES), SEQUENCES // BATCH):
            own, at = np.unique(steps[batch], return_inverse=True)
            size = bounds[own + 1] - bounds[own]
            rows = np.repeat(np.arange(len(own)), size)
            found = features[np.arange(len(rows)) + np.repeat(bounds[own] - np.cumsum(size) + size, size)]
            emission = _scores(rows, found, weights, len(own))[at.reshape(len(batch), STEPS)]
            potentials = np.exp(emission - emission.max(2, keepdims=True))
            marginals, pairs = _chain(potentials, np.exp(transitions))
            target = np.eye(k)[gold[batch]]
            change = np.zeros((len(own), k))
            np.add.at(change, at.ravel(), (target - marginals).reshape(-1, k))
            gradient = np.stack(
                [np.bincount(found, change[rows, c], minlength=BUCKETS) for c in range(k)], axis=1
            ) / len(batch) - DECAY * weights
            grown += gradient**2
            weights += RATE * gradient / np.sqrt(grown)
            true_pairs = np.zeros((k, k))
            np.add.at(true_pairs, (gold[batch][:, :-1].ravel(), gold[batch][:, 1:].ravel()), 1)
            gradient_t = (true_pairs - pairs) / len(batch)
            grown_t += gradient_t**2
            transitions += RATE * gradient_t / np.sqrt(grown_t)
    return Model(languages, weights.astype(np.float32), transitions, lexicon, lexicon_language)


def marginals(emission: np.ndarray, bounds: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward over texts of any length, text i in rows bounds[i] to bounds[i + 1].

    Texts are cut into blocks of ``BLOCK`` words; every block's passage matrix is made for all blocks at
    once, the few block ends are walked through per text, and the words follow inside the blocks.
    """
    labels = emission.shape[1]
    size = np.diff(bounds)
    blocks = -(-size // BLOCK)
    offset = np.concatenate([[0], np.cumsum(blocks)])
    n = int(offset[-1])
    if n == 0:
        return np.zeros_like(emission)
    text = np.repeat(np.arange(len(size)), blocks)
    nth = np.arange(n) - offset[text]
    at = (bounds[text] + nth * BLOCK)[:, None] + np.arange(BLOCK)[None]
    valid = at < bounds[text + 1][:, None]
    at = np.minimum(at, len(emission) - 1)
    potentials = np.exp(emission - emission.max(1, keepdims=True))[at]
    potentials[~valid] = 1
    passage = np.exp(transitions)
    product = np.tile(np.eye(labels), (n, 1, 1))
    for t in range(BLOCK):
        moved = (product.reshape(-1, labels) @ passage).reshape(n, labels, labels)
        if t == 0:
            moved[nth == 0] = product[nth == 0]
        moved *= potentials[:, t, None, :]
        moved /= moved.max((1, 2), keepdims=True)
        product = np.where(valid[:, t, None, None], moved, product)
    before, after = np.empty((n, labels)), np.empty((n, labels))
    order = np.argsort(-blocks, kind="stable")
    front = np.full((len(size), labels), 1.0 / labels)
    back = np.full((len(size), labels), 1.0 / labels)
    for j in range(int(blocks.max())):
        live = order[: np.searchsorted(-blocks[order], -j, side="left")]
        block = offset[live] + j
        before[block] = front[live]
        f = np.einsum("ni,nij->nj", front[live], product[block])
        front[live] = f / f.sum(1, keepdims=True)
        block = offset[live + 1] - 1 - j
        after[block] = back[live]
        b = np.einsum("nij,nj->ni", product[block], back[live])
        back[live] = b / b.sum(1, keepdims=True)
    alpha = np.empty((n, BLOCK, labels))
    for t in range(BLOCK):
        moved = before @ passage
        if t == 0:
            moved[nth == 0] = before[nth == 0]
        moved *= potentials[:, t]
        moved /= moved.sum(1, keepdims=True)
        before = np.where(valid[:, t, None], moved, before)
        alpha[:, t] = before
    out = np.empty_like(alpha)
    for t in range(BLOCK - 1, -1, -1):
        m = alpha[:, t] * after
        out[:, t] = m / m.sum(1, keepdims=True)
        moved = (after * potentials[:, t]) @ passage.T
        moved /= moved.sum(1, keepdims=True)
        after = np.where(valid[:, t, None], moved, after)
    result = np.empty_like(emission)
    result[at[valid]] = out[valid]
    return result


def label_texts(texts: list[str], model: Model) -> Iterator[tuple[str, float, int]]:
    """Language, score and number of switches between neighbouring words for each text."""
    for lo, hi in chunks(texts):
        part = [t.lower() for t in texts[lo:hi]]
        words = split(part)
        hashes = words.hashes
        lettered = np.concatenate([[0], np.cumsum(letters()[words.codes])])
        counts = (lettered[words.ends] > lettered[words.starts]).astype(np.float64)
        _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        rows, features = word_features(words, first, hashes, model.lexicon, model.lexicon_language)
        emission = _scores(rows, features, model.weights, len(first))[word]
        share = marginals(emission, words.bounds, model.transitions)
        best = share.argmax(1) if len(share) else np.zeros(0, np.int64)
        sums = np.concatenate([np.zeros((1, share.shape[1])), np.cumsum(share * counts[:, None], axis=0)])
        total = np.concatenate([[0], np.cumsum(counts)])
        moved = np.concatenate([[0, 0], np.cumsum(best[1:] != best[:-1])])[: len(best) + 1]
        for s, e in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            n = total[e] - total[s]
            if n <= 0:
                yield "und", 0.0, 0
                continue
            mass = (sums[e] - sums[s]) / n
            winner = int(mass.argmax())
            yield model.languages[winner], float(np.clip(mass[winner], 0, 1)), int(moved[e] - moved[min(s + 1, e)])


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``docs`` (doc_id, text, lang) outside the held-out fold.

    The sample is bounded: ``per_language`` whole texts of every language. Rows without id, text or
    language are not learned from; without any other row the model knows no language.
    """
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("label"))
    rows = rows.where("doc_id IS NOT NULL AND text IS NOT NULL AND label IS NOT NULL").where(~held_out())
    drawn = sample_per_class(rows, "label", "doc_id", per_language).orderBy("label", "doc_id", "text").collect()
    return train([r.text for r in drawn], [r.label for r in drawn])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text_hash, held_out, lang_pred, score, n_switches`` for every row of ``docs`` (doc_id, text).

    ``lang_pred`` is ``und`` with score 0 for a null text, one without a letter, or a model without
    languages; ties go to the first language by name. ``n_switches`` counts neighbouring words with
    different most likely languages. Only doc_id and text are looked at.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(3).to_pylist()]
            if known.value.languages:
                made = list(label_texts(texts, known.value))
            else:
                made = [("und", 0.0, 0)] * len(texts)
            columns = list(zip(*made, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
                 pa.array(columns[2], pa.int64())],
                names=["doc_id", "text_hash", "held_out", "lang_pred", "score", "n_switches"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), held_out().alias("held_out"),
        text.alias("text"),
    )
    return rows.mapInArrow(
        run, "doc_id long, text_hash long, held_out boolean, lang_pred string, score double, n_switches long"
    )


def keep_identified(docs: DataFrame, model: Model, least_share: float) -> DataFrame:
    """``docs``, all columns, without rows whose language is ``und`` or whose score is under ``least_share``.

    A model without languages can reject nothing: then all rows stay.
    """
    if not model.languages:
        return docs
    known, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            good = [lang != "und" and score >= least_share for lang, score, _ in label_texts(texts, known.value)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
