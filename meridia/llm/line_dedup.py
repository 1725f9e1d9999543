"""Repeated and almost repeated lines by a deletion-neighbourhood join, in DataFrame operations only.

Two lines are equal when their words are, and near when one word inserted, deleted or replaced turns one
into the other (lines of ``MIN_WORDS`` words or more). The earliest line stays: a line goes when an equal or
near line stands at an earlier place (doc_id, line number).

Every line that can have a near one emits the hash of each variant with one word left out, with the place
left out, and of itself. Lines of one length that share a variant and its place differ in that word only; a
line equal to another's variant is one word shorter. So each group of equal variants needs just the smallest
place of its lines, never its pairs, and a variant shared by a third of all lines is a sum like any other.

Only lines that share a half with another line of the same length (or the half that a line one word longer
would have) can be near one, as a single edit leaves one half whole; that test comes first and reads hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridia.session import materialize

WHITE = " \t\n\x0b\x0c\r"
MIN_WORDS = 8
_CHUNK = 16


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: document, place and words."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = rows.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(WHITE))).where("line <> ''")
    return rows.select(
        "doc_id", "text_hash", "line_no", _place().alias("place"), F.split("line", f"[{WHITE}]+").alias("words")
    )


def _place() -> Column:
    """Order of lines as one number: doc_id, then line number; null ids come last."""
    last = F.lit("9223372036854775808").cast("decimal(20,0)")
    doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), last)
    return (doc * F.lit(1 << 31).cast("decimal(10,0)") + F.col("line_no")).cast("decimal(38,0)")


def _half_keys(words: Column, n: Column) -> Column:
    """Hashes of both halves of a line, and of those it would share with lines one word shorter."""

    def part(kind: int, length: Column, begin: Column, size: Column, own: bool) -> Column:
        return F.struct(F.xxhash64(F.lit(kind), length, F.slice(words, begin, size)).alias("key"), F.lit(own).alias("own"))

    half, shorter = F.floor(n / 2).cast("int"), n - 1
    less = F.floor(shorter / 2).cast("int")
    one = F.lit(1)
    return F.array(
        part(0, n, one, half, True),
        part(1, n, half + 1, n - half, True),
        part(0, shorter, one, less, False),
        part(1, shorter, less + 2, shorter - less, False),
    )


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _running(values: str) -> list[tuple[str, Column]]:
    """Columns, one after the other, that end in running xors of an array, in chunks so that long ones stay cheap."""
    zero = F.lit(0).cast("long")
    chunks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int"))
    return [
        ("_parts", F.transform(chunks, lambda c: F.aggregate(F.slice(values, c * _CHUNK + 1, _CHUNK), zero, _xor))),
        ("_before", F.transform("_parts", lambda s, i: F.aggregate(F.slice("_parts", 1, i), zero, _xor))),
        (
            "_running",
            F.flatten(
                F.transform(
                    "_before",
                    lambda before, c: F.transform(
                        F.slice(values, c * _CHUNK + 1, _CHUNK),
                        lambda x, i: F.aggregate(F.slice(values, c * _CHUNK + 1, i + 1), before, _xor),
                    ),
                )
            ),
        ),
    ]


def _variants(lines: DataFrame) -> DataFrame:
    """Rows ``key, left_out, place, h1`` of every variant of ``lines`` (place, h1, words), 0 for the line itself.

    A sequence's hash is the xor of 64-bit hashes of (word, its place); leaving out the next word instead moves one
    word by one place, so all variants' hashes are running xors of small changes.
    """
    zero = F.lit(0).cast("long")
    rows = lines.select(
        "place",
        "h1",
        F.transform("words", lambda w, i: F.xxhash64(w, i)).alias("_here"),
        F.transform("words", lambda w, i: F.xxhash64(w, i - 1)).alias("_moved"),
    )
    rows = rows.withColumns({"_total": F.aggregate("_moved", zero, _xor), "_own": F.aggregate("_here", zero, _xor)})
    # Without the first word all others move; each next variant has one more word back at its own place.
    earlier = F.concat(F.array("_total"), F.slice("_here", F.lit(1), F.size("_here") - 1))
    rows = rows.withColumn("_changes", F.zip_with("_moved", earlier, _xor)).drop("_here", "_moved", "_total")
    for name, column in _running("_changes"):
        rows = rows.withColumn(name, column)
    n = F.size("_changes").alias("n")
    rows = rows.select("place", "h1", n, F.posexplode(F.concat(F.array("_own"), "_running")).alias("left_out", "v"))
    length = F.when(F.col("left_out") == 0, F.col("n")).otherwise(F.col("n") - 1)
    return rows.select(F.xxhash64(length, "v").alias("key"), "left_out", "place", "h1")


def _one_edit(a: str, b: str) -> Column:
    """Whether two arrays of words are one insertion, deletion or replacement apart, or equal."""
    long = F.when(F.size(a) >= F.size(b), F.col(a)).otherwise(F.col(b))
    short = F.when(F.size(a) >= F.size(b), F.col(b)).otherwise(F.col(a))
    n = F.least(F.size(a), F.size(b))
    differ = F.zip_with(F.slice(long, F.lit(1), n), short, lambda x, y: x != y)
    first = F.array_position(differ, True).cast("int")
    at = F.when(first == 0, n + 1).otherwise(first)
    after_long, after_short = F.slice(long, at + 1, n + 1), F.slice(short, at + 1, n + 1)
    replaced = (F.size(a) == F.size(b)) & (after_long == after_short)
    inserted = (F.abs(F.size(a) - F.size(b)) == 1) & (after_long == F.slice(short, at, n + 1))
    return replaced | inserted


def decisions(docs: DataFrame) -> DataFrame:
    """Lines of ``docs`` (doc_id, text) that go: ``doc_id, text_hash, line_no, near``.

    ``near`` tells a near line from an equal one. Lines without a word, null and empty texts have nothing to
    compare and stay. Equal rows with one doc_id stand at the same places and get equal results; null ids
    come after all others. Other columns are not looked at; an empty table gives an empty result.
    """
    lines = _lines(docs)
    n = F.size("words")
    hashed = lines.select(
        "doc_id",
        "text_hash",
        "line_no",
        "place",
        F.xxhash64("words").alias("h1"),
        F.xxhash64(F.lit(1), "words").alias("h2"),
        F.when(n >= MIN_WORDS, _half_keys(F.col("words"), n)).alias("halves"),
    )
    halves = [F.col("halves")[i]["key"].alias(f"k{i}") for i in range(4)]
    # Texts are split and hashed once; the numbers are read twice.
    hashed = materialize(hashed.select("doc_id", "text_hash", "line_no", "place", "h1", "h2", *halves), "line-hashes")
    keys = [F.max(f"k{i}").alias(f"k{i}") for i in range(4)]
    distinct = materialize(
        hashed.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.count("*").alias("n"), *keys), "lines"
    )
    near = _near(docs, distinct)
    of_interest = distinct.select("h1", "h2", "place", "n").join(near, ["h1", "h2"], "left")
    of_interest = of_interest.where("n > 1 OR near").select("h1", "h2", F.col("place").alias("first"), "near")
    met = hashed.select("doc_id", "text_hash", "line_no", "place", "h1", "h2").join(of_interest, ["h1", "h2"])
    return met.where("near OR place > first").select(
        "doc_id", "text_hash", "line_no", (F.coalesce("near", F.lit(False)) & (F.col("place") == F.col("first"))).alias("near")
    )


def _near(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """Hashes of the distinct lines that have a near one at an earlier place, with ``near`` true."""
    own = {0: True, 1: True, 2: False, 3: False}
    halves = F.explode(F.array(*(F.struct(F.col(f"k{i}").alias("key"), F.lit(o).alias("own")) for i, o in own.items())))
    keyed = distinct.where("k0 IS NOT NULL").select("place", "h1", halves.alias("s")).select(
        "place", "h1", "s.key", "s.own"
    )
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("own")).where("n > 1 AND own")
    chosen = keyed.select("key", "place", "h1").join(shared.select("key"), "key").select("place", "h1").distinct()
    # Their words come from the documents: one row per document that holds such a line's first place.
    doc = F.floor(F.col("place") / (1 << 31))
    line_no = (F.col("place") - doc * (1 << 31)).cast("int")
    doc_id = F.when(doc < F.lit("9223372036854775808").cast("decimal(20,0)"), doc.cast("long"))
    wanted = chosen.select(doc_id.alias("doc_id"), line_no.alias("line_no"), "place", "h1")
    wanted = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "place", "h1")).alias("at"))
    text = F.split(F.col("text").cast("string"), "\n")
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), text.alias("_lines"))
    found = wanted.join(texts, F.col("doc_id").eqNullSafe(F.col("_id"))).select("_lines", F.explode("at").alias("s"))
    line = F.btrim(F.get("_lines", F.col("s.line_no")), F.lit(WHITE))
    found = found.select("s.place", "s.h1", F.split(line, f"[{WHITE}]+").alias("words"))
    # Rows that share a doc_id may hold other lines at the same place.
    found = found.where(F.xxhash64("words") == F.col("h1")).dropDuplicates(["place", "h1"])
    # A line makes as many variants as it has words, so few megabytes of lines are spread over all tasks.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism)
    found = materialize(found.repartition(tasks, "h1"), "line-words")

    variants = materialize(_variants(found), "variants")
    replaced = variants.groupBy("key", "left_out").agg(F.min("place").alias("m"), F.count("*").alias("n"))
    replaced = replaced.where("n > 1 AND left_out > 0").drop("n")
    shorter = (
        variants.groupBy("key")
        .agg(
            F.min(F.when(F.col("left_out") == 0, F.col("place"))).alias("whole"),
            F.min(F.when(F.col("left_out") > 0, F.col("place"))).alias("cut"),
        )
        .where("whole IS NOT NULL AND cut IS NOT NULL")
    )
    other = F.when(F.col("left_out") == 0, F.col("cut")).otherwise(F.col("whole"))
    earlier = (
        variants.join(replaced, ["key", "left_out"])
        .select("place", "h1", "m")
        .unionByName(variants.join(shorter, "key").select("place", "h1", other.alias("m")))
        .where("m < place")
        .distinct()
    )
    words = found.select(F.col("place").alias("m"), F.col("words").alias("other_words"))
    checked = earlier.join(found, ["place", "h1"]).join(words, "m").where(_one_edit("words", "other_words"))
    lines = checked.select("place", "h1").distinct()
    return distinct.select("h1", "h2", "place").join(lines, ["place", "h1"]).select("h1", "h2", F.lit(True).alias("near"))


def line_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_equal, n_near, n_kept`` for every row of ``docs``: all lines, those that go, the rest."""
    gone = decisions(docs).groupBy("doc_id", "text_hash", "line_no").agg(F.max("near").alias("near"))
    gone = gone.groupBy("doc_id", "text_hash").agg(
        F.count_if(~F.col("near")).alias("n_equal"), F.count_if("near").alias("n_near")
    )
    gone = gone.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("long").alias("n_lines"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    rows = rows.join(gone, same, "left").select(
        "doc_id", "n_lines", F.coalesce("n_equal", F.lit(0)).alias("n_equal"), F.coalesce("n_near", F.lit(0)).alias("n_near")
    )
    return rows.withColumn("n_kept", F.col("n_lines") - F.col("n_equal") - F.col("n_near"))


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without the lines that go; texts that lose their last line with a word go whole.

    Texts that had no word in the first place, and null texts, stay as they are.
    """
    gone = decisions(docs).groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("_gone"))
    gone = gone.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    text = F.col("text").cast("string")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_hash"))
    rows = docs.join(gone, same, "left")
    lines = F.split(text, "\n")
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone")), lambda i: F.get(lines, i)
    )
    rows = rows.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
    rows = rows.where(F.col("_gone").isNull() | (F.btrim("text", F.lit(WHITE)) != ""))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))
