"""Small documents with every odd case, and plain Python versions of what operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
# Extra columns whose names operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, words int, place int, rep int"


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def odd_documents() -> list[tuple]:
    long = " ".join(prose(1, 30000))
    rows = [
        (1, "one two three four five six seven eight nine ten", "en", "a"),
        (1, "one two three four five six seven eight nine ten", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "b"),
        (4, " \t\n \r\n", "en", None),
        (None, "a text without an id but with words enough to stand", "de", "b"),
        (None, None, None, None),
        (5, long, "en", "a"),
        (6, "single", "de", "b"),
        (7, "𝕏 é ß — 12345 !!!", None, "c"),
        (8, "12345 67890", "de", "c"),
        (9, "one two three four five six seven eight nine eleven", "en", "a"),
    ]
    return [(*r, 0, "k", 1, 2, 3) for r in rows]


def odd(spark):
    return spark.createDataFrame(odd_documents(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None, width: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components_by_pairs(texts: dict[int, str], width: int, percent: int) -> dict[int, int]:
    sets = {i: shingles(t, width) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * len(sets[i] | sets[j]):
                    a, b = root(i), root(j)
                    parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def repeat_words(text: str) -> int:
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered: set[int] = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(covered)


def one_edit(a: list[str], b: list[str]) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))
