"""Fill-in-middle, token counts and the Merkle manifest against plain versions of what they compute."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as fx  # noqa: E402

from meridia.llm import fill_in_middle, merkle, queries, token_count  # noqa: E402

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = ["", " ", "a", " a", "a ", "  a\tb\n\n", "𝕏 é\x0bß ", "\x1c x\x85y", "<P> a b", "one two three " * 50]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("text", TEXTS)
def test_units_and_every_cut(text):
    units = UNIT.findall(text)
    cuts = fill_in_middle.SkipList(fill_in_middle.unit_ends(text))
    assert cuts.n == len(units)
    assert [cuts.code_point(r) for r in range(cuts.n + 1)] == [len("".join(units[:r])) for r in range(cuts.n + 1)]


def test_lanes_are_sparse_and_ranks_are_bounded():
    cuts = fill_in_middle.SkipList(fill_in_middle.unit_ends("w " * 20000))
    sizes = [len(lane.below) for lane in cuts.lanes]
    assert len(sizes) >= 6 and all(3 * b < a for a, b in zip(sizes, sizes[1:], strict=False) if a > 300)
    assert cuts.code_point(20000) == 39999 and cuts.code_point(20001) == 40000
    for wrong in (-1, 20002):
        with pytest.raises(IndexError):
            cuts.code_point(wrong)


def laid_out(doc_id: int | None, text: str | None) -> tuple:
    text = text or ""
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = UNIT.findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_texts_are_laid_out_and_come_back(spark):
    docs = fx.odd(spark)
    more = [(100 + i, t) for i, t in enumerate(TEXTS * 8)] + [(i, f"<<P a{i} <S b\n<M") for i in range(200, 260)]
    docs = docs.select("doc_id", "text", F.lit("x").alias("form")).unionByName(
        spark.createDataFrame([(*r, "x") for r in more], "doc_id long, text string, form string")
    )
    made = fill_in_middle.fill_in_middle(docs)
    rows = made.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    source = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:-1] for r in rows), key=key) == sorted((laid_out(*r) for r in source), key=key)
    assert sorted(r.back for r in rows) == sorted(t or "" for _, t in source)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(fx.empty(spark)).count() == 0


BPE = public_tokenizers.path("byte_bpe_50k.json")


def whole(text: str | None) -> int:
    from tokenizers import Tokenizer

    global _whole
    if _whole is None:
        _whole = Tokenizer.from_file(BPE)
    return len(_whole.encode(text or "", add_special_tokens=False).ids)


_whole = None
PIECES = [
    " ", "  ", "\n", "\n\n ", "\t", " ", " ", "᠎", "\x1c", "\x85", "word", "Word's", "'re", "'", "12345", "é", "日本語",
    "𝕏", "<|endoftext|>", "<|endof", "text|>", "...", "a" * 40, " " * 30, "!?", "́", "_", "'s't",
]


def strange(seed: int, n: int) -> str:
    r = random.Random(seed)
    return "".join(r.choice(PIECES) for _ in range(n))


def test_safe_cuts_do_not_change_counts():
    known = token_count.Counter(BPE)
    texts = [strange(i, 30) for i in range(600)]
    assert known.counts(texts) == [whole(t) for t in texts] == known.counts(texts)


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (64, 64), (40, 20), (500, 60)])
def test_spliced_counts_equal_whole_ones(spark, chunk, overlap):
    texts = [strange(1000 + i, 120) for i in range(60)]
    # No boundary within the first overlaps: these are widened, some up to the whole text.
    texts += ["a" * 3000, " " * 2000, "<|endoftext|>" * 80, "x" * 700 + " y " * 300, "日" * 900 + strange(5, 50)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[-1])] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_count.count_tokens(docs, BPE, limit=100, chunk=chunk, overlap=overlap).collect()
    want = [(i, len(t.encode()), whole(t), whole(t) > 100) for i, t in rows]
    assert sorted(map(tuple, got)) == sorted(want)


def test_alignment_is_tried_again_wider(spark):
    text = "b" * 300 + " c d"
    rows = spark.createDataFrame([("d", text), ("e", "f g " * 60)], "digest string, text string")
    first = {r.digest: r.n_tokens for r in token_count._spliced(rows, BPE, 64, 16).collect()}
    assert first == {"d": None, "e": whole("f g " * 60)}
    second = {r.digest: r.n_tokens for r in token_count._spliced(rows, BPE, 512, 16).collect()}
    assert second == {"d": whole(text), "e": whole("f g " * 60)}


def test_token_counts_of_odd_documents(spark):
    docs = fx.odd(spark).withColumn("n_tokens", F.lit("clash")).withColumn("digest", F.lit(0))
    got = token_count.count_tokens(docs, BPE, chunk=4096).collect()
    want = [(r[0], len((r[1] or "").encode()), whole(r[1]), whole(r[1]) > 1024) for r in fx.odd_documents()]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert token_count.count_tokens(fx.empty(spark), BPE).count() == 0
    with pytest.raises(ValueError, match="overlap"):
        token_count.count_tokens(docs, BPE, chunk=10, overlap=11)


def up(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return levels


def siblings(levels: list[list[str]], i: int) -> list[tuple[int, list[str]]]:
    out = []
    for level in levels[:-1]:
        run = level[i - i % 3 : i - i % 3 + 3]
        out.append((i % 3, run[: i % 3] + run[i % 3 + 1 :]))
        i //= 3
    return out


def by_hand(rows: list[tuple]) -> list[tuple]:
    """doc_id, leaf, subroot, root, proof digest, root folded from the tampered leaf of (doc_id, source, lang, n, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups: dict[str | None, list] = {}
    for row in rows:
        doc, *middle, text = row
        leaf = sha("".join(map(field, row)))
        changed = text if text is None else text.replace("\n", "")
        odd = doc is None or zlib.crc32(str(doc).encode()) % 2
        groups.setdefault(row[1], []).append((doc, leaf, leaf if odd else sha("".join(map(field, (doc, *middle, changed))))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        groups[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(up([leaf for _, leaf, _ in groups[source]]))
    top = up([t[-1][0] for t in trees])
    out = []
    for place, source in enumerate(order):
        for i, (doc, leaf, shown) in enumerate(groups[source]):
            steps = siblings(trees[place], i) + siblings(top, place)
            node = shown
            for at, others in steps:
                node = sha("".join(others[:at]) + node + "".join(others[at:]))
            proof = sha("".join(h for _, others in steps for h in others))
            out.append((doc, leaf, trees[place][-1][0], top[-1][0], proof, node))
    return out


def manifest(spark, rows: list[tuple]) -> list[tuple]:
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, idx int, shown string"
    docs = spark.createDataFrame([(*r, "clash", 5, "clash") for r in rows], schema)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2, F.lit(1)) == 1
    changed = merkle.leaf_hash([*map(F.col, fields[:-1]), F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    docs = docs.withColumn("shown", F.when(~odd, changed))
    made = merkle.manifest(docs, fields, "source", "doc_id", keep=["doc_id", "shown"])
    folded = merkle.folded(F.coalesce("shown", "leaf"), F.col("path"))
    proof = merkle.proof_digest(F.col("path"))
    return [tuple(r) for r in made.select("doc_id", "leaf", "subroot", "root", proof, folded).collect()]


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [81, 82, 4, 1, 1], [250, 9, 28], [1] * 11, [800, 2]])
def test_proofs_against_a_tree_made_by_hand(spark, sizes):
    r = random.Random(sum(sizes))
    rows = [
        (r.randrange(10**6), f"s{g}" if g else None, "en", r.choice([None, 5]), r.choice([None, "", "a\nb", "x\n\n", "é"]))
        for g, n in enumerate(sizes)
        for _ in range(n)
    ]
    assert sorted(manifest(spark, rows)) == sorted(by_hand(rows))


def test_odd_documents_have_proofs(spark):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in fx.odd_documents()] * 3
    key = lambda r: tuple(map(str, r))
    assert sorted(manifest(spark, rows), key=key) == sorted(by_hand(rows), key=key)
    assert manifest(spark, []) == []


def test_wrong_leaves_and_paths_do_not_verify(spark):
    rows = [(i, "s", "en", 1, f"text {i}") for i in range(40)]
    made = merkle.manifest(
        spark.createDataFrame(rows, "doc_id long, source string, lang string, n long, text string"),
        ["doc_id", "text"], "source", "doc_id", keep=["doc_id"],
    )
    good = made.select((merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"))
    bad = made.select((merkle.folded(F.sha2(F.lit("other"), 256), F.col("path")) == F.col("root")).alias("ok"))
    turned = made.select((merkle.folded(F.col("leaf"), F.reverse("path")) == F.col("root")).alias("ok"))
    assert good.where("ok").count() == 40 and bad.where("ok").count() == turned.where("ok").count() == 0


def test_new_queries_have_their_contract_columns():
    assert {"op11_fill_in_middle", "op13_merkle_manifest"} <= set(queries.ORACLES)
    assert "op12_token_counts" in queries.QUERIES
