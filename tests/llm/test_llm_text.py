"""Operators on documents against brute force, held-out labels and odd tables."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter
import sys
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as fx  # noqa: E402

from meridia.llm import (  # noqa: E402
    decontaminate,
    language_id,
    line_dedup,
    mixing,
    near_dedup,
    quality_classifier,
    quality_rules,
)

SF = "/root/testdata/sf0.001"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# Near duplicates


def near_texts() -> dict[int, str]:
    r = random.Random(3)
    texts = {}
    for family in range(12):
        base = fx.prose(family, r.choice([3, 9, 12, 40, 150, 700, 2500]))
        for copy in range(9):
            words = list(base)
            for _ in range(r.randrange(0, max(2, len(words) // 14))):
                words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
            texts[family * 100 + copy] = " ".join(words)
    texts[5000], texts[5001], texts[5002] = "lone", "LONE", "two words"
    return texts


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_are_those_of_all_pairs(spark, width):
    texts = near_texts()
    got = near_dedup.near_duplicates(docs_of(spark, list(texts.items())), width, 0.8).collect()
    assert {r.doc_id: r.component_id for r in got} == fx.components_by_pairs(texts, width, 80)
    assert all(r.n_shingles == len(fx.shingles(texts[r.doc_id], width)) for r in got)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_odd_rows(spark):
    got = near_dedup.near_duplicates(fx.odd(spark), 2, 0.8).collect()
    assert len(got) == len(fx.odd_documents())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        elif r.doc_id in (2, 3, 4):
            assert (r.n_shingles, r.component_id, r.kept) == (0, r.doc_id, True)
    assert {r.component_id for r in got if r.doc_id in (1, 9)} == {1}
    assert near_dedup.near_duplicates(fx.empty(spark)).count() == 0
    one = near_dedup.keep_one(fx.odd(spark), 2, 0.8)
    assert one.columns == fx.odd(spark).columns
    assert sorted(r.doc_id for r in one.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_a_family_beyond_one_block_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    r, base = random.Random(5), fx.prose(77, 120)
    texts = {}
    for i in range(60):
        words = list(base)
        for at in r.sample(range(120), r.randrange(3, 14)):
            words[at] = f"y{r.randrange(10**6)}"
        texts[i] = " ".join(words)
    got = near_dedup.near_duplicates(docs_of(spark, list(texts.items())), 2, 0.8).collect()
    assert {x.doc_id: x.component_id for x in got} == fx.components_by_pairs(texts, 2, 80)


def test_the_estimate_is_near_the_truth():
    r = np.random.default_rng(1)
    for size, shared in ((500, 400), (3000, 1500), (60, 50)):
        common = r.integers(0, 2**63, shared).astype(np.uint64)
        a, b = (
            np.unique(np.concatenate([common, r.integers(0, 2**63, size - shared).astype(np.uint64)]) * np.uint64(2))
            for _ in range(2)
        )
        ra, rb = near_dedup.registers(a)[None], near_dedup.registers(b)[None]
        value, _ = near_dedup.estimate(ra, rb, np.array([len(a)]), np.array([len(b)]))
        assert abs(value[0] - shared / (2 * size - shared)) < 0.12


# Lines


def test_lines_go_when_an_earlier_one_is_equal_or_one_word_off(spark):
    r = random.Random(9)
    bases = [fx.prose(i, r.choice([2, 7, 8, 9, 20, 70, 150]), 50) for i in range(12)]
    rows = []
    for doc in range(40):
        lines = []
        for _ in range(5):
            words = list(r.choice(bases))
            kind = r.randrange(4)
            if kind == 1:
                words[r.randrange(len(words))] = f"z{r.randrange(5)}"
            elif kind == 2:
                words.insert(r.randrange(len(words) + 1), "new")
            elif kind == 3 and len(words) > 1:
                del words[r.randrange(len(words))]
            lines.append(("  " if r.random() < 0.3 else "") + " ".join(words))
        rows.append((doc, "\n".join([*lines, ""])))
    seen, expected, near = [], {}, {}
    first = {}
    for doc, text in rows:
        for n, line in enumerate(text.split("\n")):
            words = fx.WORD.findall(line)
            if words:
                first.setdefault(tuple(words), (doc, n))
                seen.append((doc, n, words))
    for doc, n, words in seen:
        place = first[tuple(words)]
        close = len(words) >= 8 and any(
            p < place and len(o) >= 8 and fx.one_edit(words, list(o)) for o, p in first.items()
        )
        if place < (doc, n) or close:
            expected.setdefault(doc, set()).add(n)
            near[doc, n] = close and place == (doc, n)
    got = line_dedup.decisions(docs_of(spark, rows)).collect()
    assert {(x.doc_id, x.line_no) for x in got} == {(d, n) for d, v in expected.items() for n in v}
    assert all(x.near == near[x.doc_id, x.line_no] for x in got)
    assert any(near.values())
    left = {x.doc_id: x.text for x in line_dedup.drop_lines(docs_of(spark, rows)).collect()}
    for doc, text in rows:
        kept = [x for n, x in enumerate(text.split("\n")) if n not in expected.get(doc, ())]
        assert left.get(doc, "") == ("\n".join(kept) if any(map(fx.WORD.search, kept)) else "")


def test_lines_of_odd_rows(spark):
    got = line_dedup.line_counts(fx.odd(spark)).collect()
    assert len(got) == len(fx.odd_documents())
    by = {r.doc_id: r for r in got}
    assert by[2].n_lines == 0 and by[3].n_lines == 1 and by[9].n_near == 1 and by[1].n_kept == 1
    assert line_dedup.line_counts(fx.empty(spark)).count() == 0
    left = line_dedup.drop_lines(fx.odd(spark))
    assert left.columns == fx.odd(spark).columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r[0]) for r in fx.odd_documents() if r[0] != 9)


# Benchmark passages


def test_overlaps_are_those_of_all_alignments(spark):
    r = random.Random(2)
    items = [(i, " ".join(fx.prose(1000 + i, 14 + i, 10**6))) for i in range(12)] + [(90, "short item of six words here")]
    rows = []
    for doc in range(60):
        words = fx.prose(2000 + doc, 60, 10**6)
        if doc % 2:
            item = items[doc % 12][1].split()
            piece = item[r.randrange(2) :] if doc % 3 else item
            for at in r.sample(range(len(piece)), doc % 5):
                piece[at] = "changed"
            words[20:20] = [w.upper() + "," for w in piece]
        rows.append((doc, " ".join(words)))
    rows += [(100, "Short item, of six words here!"), (101, "short item of seven words here")]

    def tokens(text):
        return "".join(c if c.isalnum() else " " for c in text.lower()).split()

    found = {r.doc_id: r for r in decontaminate.contamination(
        docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for doc, text in rows:
        best = 0
        words = tokens(text)
        for _, item in items:
            item = tokens(item)
            for shift in range(-len(item), len(words)):
                lo, hi = max(0, shift), min(len(words), shift + len(item))
                equal = [words[k] == item[k - shift] for k in range(lo, hi)]
                if len(item) < 13:
                    best = max(best, len(item) if len(equal) == len(item) and all(equal) else 0)
                    continue
                if sum(equal) < 5:
                    continue
                for s in range(len(equal)):
                    for e in range(s + 13, len(equal) + 1):
                        if 100 * sum(equal[s:e]) >= 80 * (e - s):
                            best = max(best, e - s)
        assert found[doc].longest == best, doc
        assert found[doc].contaminated == (best > 0)


def test_masks_hit_every_allowed_pattern_of_substitutions():
    """Lengths of 26 and more fall into pieces of 13 to 25, one of which has at most its share of substitutions."""
    masks = [(int(m, 2), len(m)) for m in decontaminate.MASKS]
    for n in range(decontaminate.MIN_TOKENS, 26):
        changed = itertools.combinations(range(n), n * (100 - decontaminate.IDENTITY_PERCENT) // 100)
        patterns = np.array([sum(1 << i for i in places) for places in changed], np.int64)
        hit = np.zeros(len(patterns), bool)
        for mask, span in masks:
            for at in range(n - span + 1):
                hit |= (patterns & (mask << at)) == 0
        assert hit.all(), (n, int((~hit).sum()))


def test_three_substitutions_in_fifteen_tokens_are_found(spark):
    item = fx.prose(77, 15, 10**6)
    rows = []
    for doc, places in enumerate(itertools.combinations(range(15), 3)):
        words = list(item)
        for at in places:
            words[at] = "changed"
        rows.append((doc, " ".join([*fx.prose(5000 + doc, 9, 10**6), *words, *fx.prose(6000 + doc, 9, 10**6)])))
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = decontaminate.contamination(docs_of(spark, rows), items)
    assert got.where("contaminated AND longest >= 13").count() == len(rows) == 455


def test_benchmark_on_odd_rows(spark):
    items = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "one two three four five six", 1), (3, "nine ten " * 9, 2)],
                                  "item_id long, text string, seed int")
    got = decontaminate.contamination(fx.odd(spark), items).collect()
    assert len(got) == len(fx.odd_documents()) and {r.doc_id for r in got if r.contaminated} == {1, 9}
    assert decontaminate.contamination(fx.odd(spark), items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(fx.empty(spark), items).count() == 0
    left = decontaminate.drop_contaminated(fx.odd(spark), items)
    assert left.columns == fx.odd(spark).columns and left.count() == len(got) - 3


# Quality


def test_statistics_are_counted_over_whole_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        fx.odd(spark).select("doc_id", "text"))
    texts = docs.collect()
    got = quality_rules.statistics(docs).collect()
    assert len(got) == len(texts)
    expected = []
    for doc, text in texts:
        text = text or ""
        words = fx.WORD.findall(text)
        lines = [x for x in text.split("\n") if fx.WORD.search(x)]
        expected.append((doc, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                         len(lines) - len(set(lines)), fx.repeat_words(text)))
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got]
    assert sorted(found, key=str) == sorted(expected, key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_rules_part_good_from_bad(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_rules.judge(docs, labels).join(labels, "doc_id").where("NOT base_failed")
    right = got.agg(F.avg(((F.col("quality") == 1) == F.col("kept")).cast("int"))).first()[0]
    assert right > 0.98
    none = quality_rules.judge(fx.odd(spark), labels.limit(0)).collect()
    assert len(none) == len(fx.odd_documents()) and all(r.kept == (not r.base_failed) for r in none)
    assert quality_rules.judge(fx.empty(spark), labels).count() == 0


def test_classifier_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    got = quality_classifier.score(docs, model).join(labels, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.95
    rows = quality_classifier.score(fx.odd(spark), model).collect()
    assert len(rows) == len(fx.odd_documents()) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    nothing = quality_classifier.fit(docs, labels.limit(0))
    assert {r.score for r in quality_classifier.score(fx.odd(spark), nothing).collect()} == {0.5}
    assert quality_classifier.score(fx.empty(spark), model).count() == 0


# Language


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs)
    got = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    rows = {r.doc_id: r for r in language_id.identify(fx.odd(spark), model).collect() if r.doc_id}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (2, 3, 4, 8))
    assert rows[6].lang_pred in model.languages and 0 < rows[6].score <= 1
    kept = language_id.keep_identified(fx.odd(spark), model, 0.0)
    assert kept.columns == fx.odd(spark).columns and {r.doc_id for r in kept.collect()} == {1, 5, 6, 7, 9, None}
    nothing = language_id.fit(fx.empty(spark))
    assert {r.lang_pred for r in language_id.identify(fx.odd(spark), nothing).collect()} == {"und"}
    assert language_id.identify(fx.empty(spark), model).count() == 0


def test_words_switch_language_inside_a_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs)
    texts = {r.lang: r.text.split() for r in docs.where("length(text) > 2000").orderBy("doc_id").collect()}
    mixed = " ".join(texts["en"][:60] + texts["de"][:40])
    ((lang, score, switches),) = list(language_id.label_texts([mixed], model))
    assert lang == "en" and 0.5 < score < 0.8 and 1 <= switches <= 4


def test_blocks_give_the_marginals_of_a_plain_chain():
    r = np.random.default_rng(0)
    emission, passage = r.normal(size=(200, 4)), r.normal(size=(4, 4))
    bounds = np.array([0, 0, 1, 33, 34, 98, 200])
    got = language_id.marginals(emission, bounds, passage)
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        if e > s:
            plain, _ = language_id._chain(np.exp(emission[s:e])[None], np.exp(passage))
            np.testing.assert_allclose(got[s:e], plain[0], atol=1e-9)


# Mixing


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = mixing.mix(docs)
    got = mixing.taken(plan).toPandas()
    assert (got["taken"] <= 2 * got["size"]).all()
    by = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert ((by.taken - by.target).abs() <= 0.5).all()
    # Targets by filling round after round.
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(sorted(by.index))}
    open_, left, target = set(by.index), 1.5 * by["size"].sum(), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * by["size"][s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * by["size"][s]
            left -= target[s]
        open_ -= over
    assert all(abs(target[s] - by.target[s]) < 1e-6 for s in by.index)
    blocks = mixing.mixed_blocks(docs, plan).toPandas()
    assert (blocks.text.str.split(" ").str.len() == blocks.n_words).all()
    assert blocks.n_words.sum() == got.taken.sum()
    again = mixing.taken(mixing.mix(docs)).toPandas()
    assert again.sort_values("doc_id").taken.tolist() == got.sort_values("doc_id").taken.tolist()


class PlainMix:
    """The mix in plain Python, draw by draw, over the same hashes."""

    SEED = 1

    @staticmethod
    def hashed(*values) -> int:
        state = 42
        for v in values:
            data = v.encode() if isinstance(v, str) else v.to_bytes(8 if abs(v) >= 1 << 31 else 4, "little", signed=True)
            state = xxhash.xxh64_intdigest(data, state)
        return state - (1 << 64) if state >> 63 else state

    @classmethod
    def permuted(cls, x: int, size: int, *seed) -> int:
        for r in range(1, mixing.ROUNDS + 1):
            partner = (cls.hashed("key", r, *seed) % size - x) % size
            if cls.hashed("swap", r, Long(max(x, partner)), *seed) % 2 == 1:
                x = partner
        return x

    @classmethod
    def taken(cls, sources: list[tuple[str, int, float]]) -> tuple[list[Counter], dict[str, list[int]]]:
        """Drawn counts by shard, and of every source how often each of its words is taken."""
        plan, wanted = [], {}
        for source, size, target in sources:
            blocks, words = -(-size // mixing.BLOCK), math.floor(target + 0.5)
            passes, rest = divmod(words, size)
            wanted[source] = (size, blocks, passes, rest, passes * blocks - (-rest // mixing.BLOCK))
            plan += [source] * wanted[source][4]
        drawn, shards = {s: 0 for s in wanted}, [Counter() for _ in range(-(-len(plan) // mixing.SHARD_SLOTS))]
        for i in range(len(plan)):
            source = plan[cls.hashed("draw", cls.SEED, Long(i)) % len(plan)]
            shards[i // mixing.SHARD_SLOTS][source] += 1
            drawn[source] += 1
        # Permuted numbers past the slots go to the others' missing numbers: each source has every number once.
        times = {}
        for source, (size, blocks, passes, rest, slots) in wanted.items():
            times[source] = [0] * size
            for number in range(slots):
                turn, index = divmod(number, blocks)
                key = cls.hashed("s" + source)
                block = index if index == blocks - 1 else cls.permuted(index, max(blocks - 1, 1), cls.SEED, Long(key), Long(turn))
                end = (block + 1) * mixing.BLOCK
                if turn == passes:
                    end = min(end, block * mixing.BLOCK + rest - index * mixing.BLOCK)
                for w in range(block * mixing.BLOCK, min(end, size)):
                    times[source][w] += 1
        return shards, times


class Long(int):
    """An integer that is hashed as eight bytes."""

    def to_bytes(self, length=8, byteorder="little", *, signed=True):
        return int(self).to_bytes(8, byteorder, signed=signed)


def test_mix_is_that_of_a_plain_draw(spark):
    r = random.Random(8)
    rows = [(i, " ".join(["w"] * r.choice([0, 1, 40, 300, 2000])), r.choice("aabc")) for i in range(400)]
    rows += [(1000, " ".join(["w"] * 20), "d"), (1001, "w " * 130, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix(docs)
    sources = [(x.source, x.source_size, x.target) for x in plan.sources.orderBy("source").collect()]
    shards, times = PlainMix.taken(sources)
    # Words of a document by the place where the plan laid it.
    places = {(p.doc_id, p.from_word): (p.source_key, p.block * mixing.BLOCK + p.at, p.words) for p in plan.pieces.collect()}
    key_of = {x.source_key: x.source for x in plan.sources.collect()}
    expected = Counter()
    for (doc, _), (key, begin, n) in places.items():
        expected[doc] += sum(times[key_of[key]][begin : begin + n])
    got = {x.doc_id: x.taken for x in mixing.taken(plan).collect()}
    assert got == {i: expected[i] for i in got}
    drawn = mixing._drawn(plan.sources, 1).groupBy("shard", "source_key").count().collect()
    assert {(x.shard, key_of[x.source_key]): x["count"] for x in drawn} == {
        (i, s): n for i, c in enumerate(shards) for s, n in c.items()
    }
    # Every slot of every shard is filled once.
    filled = plan.slots.select("shard", "slot").distinct().count()
    assert filled == plan.slots.count() == sum(sum(c.values()) for c in shards)


def test_mix_of_odd_rows(spark):
    got = mixing.taken(mixing.mix(fx.odd(spark))).collect()
    assert len(got) == len(fx.odd_documents())
    for r in got:
        assert r.taken <= 2 * r.size and r.source_size >= r.size
    assert {r.size for r in got if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.taken(mixing.mix(fx.empty(spark))).count() == 0
    assert mixing.mixed_documents(fx.odd(spark)).columns[: len(fx.odd(spark).columns)] == fx.odd(spark).columns


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutations_hit_every_place_once(spark, n):
    rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit("s"), F.lit(3)).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(n))
