"""Chat formatting, archives, URL lists and the pipeline."""

from __future__ import annotations

import datetime
import gzip
import hashlib
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as fx  # noqa: E402

from meridia.llm import chat_format, queries, url_filter, warc  # noqa: E402


@pytest.mark.parametrize(
    "text", ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x", "<||>", "a <b| c", "", "<|" * 50]
)
def test_escapes_come_back(text):
    made = chat_format.escape(text)
    assert "<|" not in made and chat_format.unescape(made) == text


def test_masks_cover_learned_segments():
    ids, mask = chat_format.assemble([([1, 2], False), ([], True), ([3, 4, 5], True), ([6], True), ([7], False)])
    assert ids.tolist() == [1, 2, 3, 4, 5, 6, 7] and mask.tolist() == [0, 0, 1, 1, 1, 1, 0]


def test_conversations_come_back_from_their_tokens(spark):
    rows = [
        (1, 1, "assistant", "<|im_end|> second"), (1, 0, "user", "first\nline"), (1, 2, "assistant", None),
        (2, 0, None, "role\\less <\\|"), (None, 5, "assistant", "no id"), (3, None, "user", ""),
        (4, 0, "user", "same"), (4, 0, "user", "same"), (5, 0, "we|ird\nrole<|", "𝕏 é" * 5000),
    ]
    turns = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    at = queries._tokenizer()
    formatted = chat_format.format_chat(turns, *at)
    got = {r.conv_id: r for r in chat_format.read_back(formatted, *at).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1] if r[1] is not None else -1)
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        learned = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert got[conv].loss_chars == len(learned)
        marks = sum(map(len, chat_format.MARKS)) * len(mine)
        assert got[conv].formatted_chars == marks + sum(
            len(chat_format.escape(r[2] or "")) + len(chat_format.escape(r[3] or "")) for r in mine
        )
    whole = {r.conv_id: r for r in chat_format.conversations(formatted).collect()}
    assert all(len(r.input_ids) == len(r.loss_mask) for r in whole.values())
    starts = formatted.select("conv_id", "turn_no", "token_start", F.size("ids").alias("n")).orderBy("turn_no").collect()
    for conv in whole:
        mine = [r for r in starts if r.conv_id == conv]
        assert [r.token_start for r in mine] == np.cumsum([0, *(r.n for r in mine)])[:-1].tolist()
    assert chat_format.read_back(chat_format.format_chat(turns.limit(0), *at), *at).count() == 0


def record(n: int) -> bytes:
    block = bytes([n % 256]) * n
    return warc.write_record(
        [("WARC-Record-ID", f"<{n}>"), ("WARC-Block-Digest", warc.digest_header(hashlib.sha1(block).digest()))], block
    )


@pytest.mark.parametrize("step", [1, 7, 1000, 10**6])
def test_records_are_framed_from_pieces_of_any_size(step):
    data = b"".join(record(n) for n in (0, 1, 5, 3000))
    pieces = (data[i : i + step] for i in range(0, len(data), step))
    assert [len(r.block) for r in warc.read_records(pieces)] == [0, 1, 5, 3000]
    assert data[:2] == b"\x1f\x8b" and gzip.decompress(data).count(b"WARC/1.1\r\n") == 4


def test_broken_archives_are_refused():
    data = record(500)
    with pytest.raises(ValueError, match="inside"):
        list(warc.read_records(iter([data[:-5]])))
    plain = gzip.decompress(data)
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(iter([gzip.compress(plain.replace(b"\xf4\xf4\xf4", b"\xf4x\xf4", 1))])))
    with pytest.raises(ValueError, match="stated"):
        list(warc.read_records(iter([gzip.compress(plain.replace(b"Content-Length: 500", b"Content-Length: 400"))])))


def test_pages_come_back_from_archives(spark):
    big, other = "<p>ä</p>" * 200, "<b>x</b>" * 200
    rows = [(1, "u1", big), (2, "u2", big), (9, "u9", big), (3, None, "small"), (4, "u4", "small"), (5, "u 5\r\nX: y", None),
            (6, "u6", ""), (7, "u7", other), (7, "u7", other), (None, "un", big), (None, "un", "é" * 5000)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, sha1 string")
    got = sorted(warc.round_trip(pages).collect(), key=str)
    assert len(got) == len(rows)
    for r in got:
        html = [(h or "").encode() for p, _, h in rows if p == r.page_id]
        assert r.payload_digest in {hashlib.sha1(h).hexdigest() for h in html}
        assert r.payload_bytes in {len(h) for h in html}
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got if r.page_id}
    assert kinds[1] == kinds[2] == ("revisit", 9) and kinds[9] == ("response", None)
    assert all(kinds[i] == ("response", None) for i in (3, 4, 5, 6, 7))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_lists_hold_from_addition_to_removal(spark):
    day = datetime.date
    entries = [
        ("l", "block", "domain", "Bad.example.", "add", day(2024, 1, 10)),
        ("l", "block", "domain", "bad.example", "add", day(2024, 1, 12)),
        ("l", "block", "domain", "bad.example", "remove", day(2024, 2, 1)),
        ("l", "block", "domain", "bad.example", "remove", day(2024, 5, 1)),
        ("l", "block", "domain", "bad.example", "add", day(2024, 5, 1)),
        ("m", "block", "prefix", "ok.example/a/b/", "add", day(2024, 1, 1)),
        ("n", "block", "url", "one.example/p?q=1", "add", day(2024, 1, 1)),
        ("w", "allow", "domain", "good.bad.example", "add", day(2024, 1, 1)),
        ("z", "block", "domain", None, "add", day(2024, 1, 1)),
        ("z", "block", "domain", "bad.example", "other", day(2024, 1, 1)),
    ]
    captures = [
        (1, "http://bad.example/", day(2024, 1, 9), []), (2, "http://BAD.example/", day(2024, 1, 10), ["l"]),
        (3, "https://sub.bad.example:80/x", day(2024, 1, 31), ["l"]), (4, "http://bad.example", day(2024, 2, 1), []),
        (5, "http://bad.example", day(2030, 5, 1), ["l"]), (6, "http://notbad.example/", day(2024, 1, 20), []),
        (7, "http://ok.example/a/b/c?x", day(2024, 3, 1), ["m"]), (8, "http://ok.example/a/bc", day(2024, 3, 1), []),
        (9, "http://one.example/p?q=1#frag", day(2024, 3, 1), ["n"]), (10, "http://one.example/p", day(2024, 3, 1), []),
        (11, "http://good.bad.example/", day(2024, 1, 20), ["l", "w"]), (12, None, day(2024, 1, 20), []),
        (13, "not a url", day(2024, 1, 20), []), (14, "http://bad.example/", None, []), (15, "", day(2024, 1, 1), []),
        (2, "http://BAD.example/", day(2024, 1, 10), ["l"]), (None, "http://bad.example/", day(2024, 1, 20), ["l"]),
    ]
    e = spark.createDataFrame(entries, "list_name string, effect string, kind string, value string, action string, day date")
    c = spark.createDataFrame([(*r[:3], 1) for r in captures], "page_id long, url string, fetched date, slice int")
    got = url_filter.evaluate(c, e).collect()
    assert len(got) == len(captures)
    expected = sorted((str(r[0]), str(r[2]), r[3], bool(r[3]) and "w" not in r[3]) for r in captures)
    assert sorted((str(r.page_id), str(r.fetched), list(r.lists), r.blocked) for r in got) == expected
    assert url_filter.evaluate(c, e.limit(0)).where("blocked").count() == 0
    assert url_filter.evaluate(c.limit(0), e).count() == 0


def test_pipeline_stages_do_what_they_say(spark, tmp_path):
    """The stages on a small folder, each against plain Python over what the stage before kept."""
    import corpus_pipeline

    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet").unionByName(
        fx.odd(spark).select(F.col("doc_id") + 10**6, "text", "lang", "source", "n_chars").toDF("doc_id", "text", "lang", "source", "n_chars")
    )
    columns = docs.columns
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, source), name)
        after[name] = (before.collect(), docs.collect())
        if name != "mixing":
            assert docs.columns == columns
    before, left = after["language_id"]
    gone = {r.doc_id for r in before} - {r.doc_id for r in left}
    assert {10**6 + i for i in (2, 3, 4, 8)} <= gone and len(gone) <= 6
    before, left = after["line_dedup"]
    assert {r.doc_id for r in left} <= {r.doc_id for r in before}
    lines = [tuple(fx.WORD.findall(x)) for r in {(r.doc_id, r.text): r for r in left}.values()
             for x in r.text.split("\n") if fx.WORD.search(x)]
    assert len(lines) == len(set(lines))
    before, left = after["near_dedup"]
    texts = {r.doc_id: r.text for r in before if r.doc_id is not None}
    kept = {i for i, c in fx.components_by_pairs(texts, 5, 80).items() if i == c}
    assert {r.doc_id for r in left if r.doc_id is not None} == kept
    before, left = after["decontamination"]
    items = [r.text.lower() for r in spark.read.parquet(f"{source}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in before if any(i in r.text.lower() for i in items)}
    assert not whole & {r.doc_id for r in left}
    assert len(before) - len(left) <= 2 * len(whole) + 2
    before, left = after["mixing"]
    sizes = {r.doc_id: len(fx.WORD.findall(r.text or "")) for r in before}
    assert left and all(0 < r.taken <= 2 * sizes[r.doc_id] for r in left)


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).parents[2]
    for path in [*(root / "meridia").rglob("*.py"), *(root / "workload").rglob("*.py")]:
        if "llm" not in path.relative_to(root).parts:
            assert "meridia.llm" not in path.read_text() and "import llm" not in path.read_text()
