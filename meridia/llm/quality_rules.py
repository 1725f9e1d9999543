"""Quality rules learned as an ordered decision list over text statistics, all in Spark expressions.

Sequential covering: a rule is grown from threshold conditions, each the one with the largest information
gain on the growing part of the labelled rows; it is pruned back to the prefix that does best on the other
part; rows it covers are set aside and the next rule is grown. Every step is one aggregate of counts per
statistic and bin, so the driver sees counts only. The list becomes one conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridia.session import materialize

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
# Statistics that conditions may use.
FEATURES = (
    "n_words",
    "mean_word_chars",
    "symbols_per_100_words",
    "marks_per_100_words",
    "capital_share",
    "repeat_share",
    "distinct_share",
    "dup_line_share",
)
BINS = 32
MAX_RULES, MAX_CONDITIONS = 12, 4


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


@dataclass(frozen=True)
class RuleList:
    """Rules that reject a row; each is a conjunction, the first that holds decides, a row without one is kept."""

    rules: tuple[tuple[Condition, ...], ...] = field(default=())

    def column(self) -> Column:
        """Number of the first rule that holds, from 1; null if none does."""
        out = F.lit(None).cast("int")
        for i, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(_all(rule), F.lit(i)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(" AND ".join(map(str, rule)) for rule in self.rules)


def _all(rule: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _share(part: str, whole: str, factor: float = 1.0) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) * F.lit(factor) / F.col(whole)).otherwise(0.0)


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """Counts and shares of every row of ``docs`` (doc_id, text), whole texts; a null text counts as empty.

    Words are runs of characters other than space and U+0009 to U+000D. ``n_repeat_words`` counts words in
    windows of eight that occur twice or more in the text, the first included; ``n_dup_lines`` counts lines
    with a word that equal an earlier line. Equal rows get equal results. Other columns are not looked at.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    trimmed = F.btrim("text", F.lit(WHITE))
    rows = rows.select(
        "doc_id",
        "text",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{WHITE}]+")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "").alias("lines"),
    )
    n = F.size("words")
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        _without(F.col("text"), WHITE).cast("long").alias("word_chars"),
        (F.length("text") - _without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length("text") - _without(F.col("text"), CAPITALS)).cast("long").alias("n_capitals"),
        (F.length("text") - _without(F.col("text"), "!?")).cast("long").alias("n_marks"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        F.when(n >= WINDOW, windows).alias("windows"),
    )
    # Only texts where some window occurs twice are sorted.
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(twice, placed)).drop("windows")

    def again(s: Column, k: Column) -> Column:
        before = (k > 0) & (F.get("placed", k - 1)["h"] == s["h"])
        return before | (F.coalesce(F.get("placed", k + 1)["h"] == s["h"], F.lit(False)))

    repeated = F.sort_array(F.transform(F.filter("placed", again), lambda s: s["i"]))
    rows = rows.withColumn("repeated", F.when(F.col("placed").isNotNull(), repeated)).drop("placed")
    reach = F.transform(
        "repeated", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("repeated", k + 1) - p, F.lit(WINDOW)))
    )
    total = F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("repeated")
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        _share("word_chars", "n_words").alias("mean_word_chars"),
        _share("n_symbols", "n_words", 100.0).alias("symbols_per_100_words"),
        _share("n_marks", "n_words", 100.0).alias("marks_per_100_words"),
        _share("n_capitals", "word_chars").alias("capital_share"),
        _share("n_repeat_words", "n_words").alias("repeat_share"),
        _share("n_distinct_words", "n_words").alias("distinct_share"),
        _share("n_dup_lines", "n_lines").alias("dup_line_share"),
        ((F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)).alias("base_failed"),
    )


def learn(stats: DataFrame, labels: DataFrame) -> RuleList:
    """Decision list from the statistics of rows that ``labels`` (doc_id, quality) marks, base failures left out.

    Ids marked both ways and null marks are not used. Without rows of label 0 the list is empty.
    """
    marks = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .where("label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("doc_id", (F.col("label") == 0).alias("bad"))
    )
    grow = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(3)) > 0).alias("grow")
    known = stats.where("NOT base_failed").select("doc_id", *FEATURES).join(marks, "doc_id")
    known = materialize(known.select(*FEATURES, "bad", grow), "labelled")
    cuts = _cuts(known)
    rules: list[tuple[Condition, ...]] = []
    left = F.lit(True)
    while len(rules) < MAX_RULES:
        rule = _grow(known.where(left & F.col("grow")), cuts)
        rule = _prune(known.where(left), rule)
        if not rule:
            break
        rules.append(rule)
        left = left & ~_all(rule)
    return RuleList(tuple(rules))


def _cuts(known: DataFrame) -> dict[str, list[float]]:
    """Thresholds per statistic: halfway between neighbouring quantiles of good and of bad rows."""
    steps = [i / BINS for i in range(BINS + 1)]
    both = known.groupBy("bad").agg(*(F.percentile_approx(f, steps, 10000).alias(f) for f in FEATURES)).collect()
    out = {}
    for f in FEATURES:
        values = sorted({v for r in both for v in r[f]})
        out[f] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    return out


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition, ...]:
    rule: tuple[Condition, ...] = ()
    while len(rule) < MAX_CONDITIONS:
        best, gain, clean = _best_condition(rows.where(_all(rule)), cuts)
        if best is None or gain <= 0:
            break
        rule += (best,)
        if clean:
            break
    return rule


def _best_condition(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition | None, float, bool]:
    """The condition with the largest gain, its gain, and whether it covers bad rows only."""
    bins = []
    for i, f in enumerate(FEATURES):
        bins.append(F.struct(F.lit(i).alias("f"), _bin(F.col(f), cuts[f]).alias("bin")))
    counted = rows.select("bad", F.explode(F.array(*bins)).alias("s")).groupBy("s.f", "s.bin").agg(
        F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")
    )
    table: dict[int, dict[int, tuple[int, int]]] = {}
    for r in counted.collect():
        table.setdefault(r.f, {})[r.bin] = (r.bad, r.good)
    best, most, clean = None, 0.0, False
    for i, f in enumerate(FEATURES):
        per_bin = table.get(i, {})
        bad, good = (sum(v[k] for v in per_bin.values()) for k in (0, 1))
        if not bad or not good:
            continue
        below = [0, 0]
        for j, cut in enumerate(cuts[f]):
            below = [below[k] + per_bin.get(j, (0, 0))[k] for k in (0, 1)]
            for above, p, n in ((False, below[0], below[1]), (True, bad - below[0], good - below[1])):
                if p:
                    gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                    # Of conditions that cover the same labelled rows, the one that covers less.
                    if gain > most or (above and gain == most and best is not None and best.feature == f and best.above):
                        best, most, clean = Condition(f, above, float(cut)), gain, n == 0
    return best, most, clean


def _bin(value: Column, cuts: list[float]) -> Column:
    """Number of cuts below a value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: t < value)) if cuts else F.lit(0)


def _prune(rows: DataFrame, rule: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The prefix with the best balance of bad over good rows that it was not grown from; empty when good ones
    prevail. A rule that covers none of those rows is judged by all."""
    if not rule:
        return ()
    counts = []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k])
        for name, other in (("", ~F.col("grow")), ("all_", F.lit(True))):
            counts += [
                F.count_if(hit & other & F.col("bad")).alias(f"{name}p{k}"),
                F.count_if(hit & other & ~F.col("bad")).alias(f"{name}n{k}"),
            ]
    got = rows.agg(*counts).first()
    name = "" if got["p1"] + got["n1"] else "all_"
    pairs = [(got[f"{name}p{k}"], got[f"{name}n{k}"], k) for k in range(1, len(rule) + 1)]
    value, negative = max(((p - n) / max(p + n, 1), -k) for p, n, k in pairs)
    return rule[:-negative] if value > 0 else ()


def apply(stats: DataFrame, rules: RuleList) -> DataFrame:
    """``stats`` with ``rule``, the number of the first rule that rejects the row, and ``kept``."""
    out = stats.withColumn("rule", F.when(~F.col("base_failed"), rules.column()))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base verdict, rule and final verdict of every row of ``docs``; see the functions above.

    Empty and null texts have no words and fail the base rule; an empty table gives an empty result; a null
    doc_id is judged but never learned from.
    """
    stats = materialize(statistics(docs), "statistics")
    return apply(stats, learn(stats, labels))
