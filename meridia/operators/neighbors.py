"""Exact nearest neighbours by pivot cells.

Rows are placed in the cell of their nearest pivot. The distances to the pivots bound how far the
k-th neighbour of any row of a cell can be, so by the triangle inequality a point needs to meet only
the cells it could matter to (Lu, Shen, Chen & Ooi 2012). Queries of cells near each other share a bundle
of bounded size. One task holds a bundle while the points that matter to it stream past, and keeps the k
nearest so far of every query, never the pairs. A matrix product of single precision, whose error is bounded,
finds the few points that can be nearer, and the distances of these alone are summed dimension by dimension.
Copies of one vector are merged first: a vector stands for its k + 1 smallest ids, which is all that can be
asked of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_int, hash_key

BLOCK_ROWS = 1024
MAX_PIVOTS = 1024
# Rows that meet in one task: at most so many bytes of vectors, and small enough for this many bundles.
BUNDLE_BYTES = 1 << 24
LEAST_BUNDLES = 16
MEETING_PARTITIONS = 2048
# Queries that a task holds: a share of all, so that a point is sent to so many tasks, up to this many bytes of vectors.
STREAMS = 36
HELD_BYTES = 1 << 27
# Points that a block of queries meets at a time, and pairs whose distances are summed at a time.
STEP = 2048
PAIRS = 1 << 15
# With more candidates than so many for each one wanted, single precision is not enough.
MANY = 16
# Up to this width a plain sum over the dimensions is as fast as a matrix product.
NARROW = 8


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances of two small blocks, summed dimension by dimension without cancellation."""
    total = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        total += (a[:, d, None] - b[None, :, d]) ** 2
    return total


def rough_squared_distances(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All squared distances by a matrix product, and per row of ``a`` how far they can be off."""
    if a.shape[1] <= NARROW:
        return squared_distances(a, b), np.zeros(len(a))
    middle = b.mean(axis=0)
    a0, b0 = a - middle, b - middle
    a2, b2 = np.einsum("ij,ij->i", a0, a0), np.einsum("ij,ij->i", b0, b0)
    off = 8 * (a.shape[1] + 8) * np.finfo(float).eps * (a2 + b2.max(initial=0.0))
    if not np.isfinite(off).all():
        return squared_distances(a, b), np.zeros(len(a))
    total = a0 @ (-2.0 * b0.T)
    total += a2[:, None]
    total += b2[None, :]
    return total, off


def pair_distances(a: np.ndarray, b: np.ndarray, rows: int = 1 << 16) -> np.ndarray:
    """Squared distances of paired rows, summed as ``squared_distances`` does."""
    total = np.zeros(len(a))
    for at in range(0, len(a), rows):
        for d in range(a.shape[1]):
            total[at : at + rows] += (a[at : at + rows, d] - b[at : at + rows, d]) ** 2
    return total


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of arrays of one length as rows."""
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), len(values) // max(1, len(column)))


def bundle_rows(rows: int, width: int, block_rows: int) -> int:
    """Rows a bundle may hold: bounded by its bytes, and less where a table would give too few bundles."""
    most = max(1, BUNDLE_BYTES // (8 * max(1, width)))
    return min(most, max(block_rows, math.ceil(rows / LEAST_BUNDLES)))


def held_rows(rows: int, width: int, block_rows: int) -> int:
    """Queries that one task may hold while points stream past."""
    return min(max(1, HELD_BYTES // (8 * max(1, width))), max(block_rows, math.ceil(rows / STREAMS)))


def nearest(x: np.ndarray, centers: np.ndarray, rows: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (the first on a tie) and its squared distance, a few rows at a time."""
    at, best = np.empty(len(x), dtype="int32"), np.empty(len(x))
    for start in range(0, len(x), rows):
        d2 = squared_distances(x[start : start + rows], centers)
        at[start : start + rows] = d2.argmin(axis=1)
        best[start : start + rows] = d2.min(axis=1)
    return at, best


def merge_copies(df: DataFrame, key: str, vector: str, group: str, keep: int) -> DataFrame:
    """One row per (group, vector): its ``keep`` smallest ids and the first of them."""
    copies = Window.partitionBy("g", "x").orderBy("id")
    return (
        df.select(F.col(group).alias("g"), F.col(vector).alias("x"), F.col(key).alias("id"))
        .withColumn("rn", F.row_number().over(copies))
        .where(F.col("rn") <= keep)
        .groupBy("g", "x")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("rep", F.col("ids")[0])
    )


def _nearest_pivot(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the cell and the distance to its pivot."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                yield pd.DataFrame({"cell": [], "radius": []})
                continue
            cell, d2 = nearest(np.stack(batch.to_numpy()), shared.value)
            yield pd.DataFrame({"cell": cell, "radius": np.sqrt(d2)})

    placed = F.pandas_udf(as_udf(place), "cell int, radius double")
    return df.withColumn("__p", placed("x")).select("*", "__p.cell", "__p.radius").drop("__p")


def as_udf(fn):
    """pandas_udf reads real annotations; this module keeps them as text."""
    fn.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return fn


def knn_join(
    points: DataFrame,
    key: str,
    vector: str,
    k: int,
    group: str | None = None,
    queries: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    pivots: int | None = None,
) -> DataFrame:
    """The k nearest other points of each query row: ``(key, neighbor, distance, rank)``.

    Order is (distance, id). With ``group``, neighbours come from the row's own group only. A query
    that is itself a point (same id) is not its own neighbour.
    """
    if group is None:
        points = points.withColumn("__group", F.lit(0))
        queries = queries.withColumn("__group", F.lit(0)) if queries is not None else None
        group = "__group"
    same = queries is None
    queries = points if same else queries
    sites = merge_copies(points, key, vector, group, k + 1).persist()
    asked = sites if same else merge_copies(queries, key, vector, group, 1)
    # cells are those of one group each, so the largest group decides how many there are
    sizes = sites.groupBy("g").count().agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
    m = pivots or max(1, math.ceil((sizes["most"] or 0) / block_rows))
    m = min(m, MAX_PIVOTS, max(1, sizes["n"] or 0))
    order = [hash_key("pivot", "rep"), F.col("rep")]
    chosen = np.array([r["x"] for r in sites.select("x", "rep").orderBy(*order).limit(m).collect()], dtype=float)
    if not len(chosen):
        return points.sparkSession.createDataFrame([], _result_type(points, key))
    placed = _nearest_pivot(sites, chosen).persist()
    asked = placed if same else _nearest_pivot(asked, chosen).persist()
    plan = _meeting_plan(placed, asked, chosen, k, block_rows)
    lists = _meet(placed, asked, plan, chosen, k, held_rows(sizes["n"], chosen.shape[1], block_rows))
    per_vector = asked.select("g", "x", "rep").join(lists, ["g", "rep"]).select("g", "x", "near")
    rows = queries.select(F.col(group).alias("g"), F.col(vector).alias("x"), F.col(key).alias(key))
    # copies of one vector share its list; adaptive skew handling splits a vector with many rows
    joined = rows.join(per_vector, ["g", "x"])
    others = F.filter("near", lambda n: n["id"] != F.col(key))
    return joined.select(key, F.posexplode(F.slice(others, 1, k)).alias("pos", "n")).select(
        key,
        F.col("n.id").alias("neighbor"),
        F.col("n.distance").alias("distance"),
        (F.col("pos") + 1).alias("rank"),
    )


def _result_type(points: DataFrame, key: str) -> str:
    kind = points.schema[key].dataType.simpleString()
    return f"`{key}` {kind}, neighbor {kind}, distance double, rank int"


_STATS = {"g": object, "cell": int, "n": int, "widest": float, "smallest": object}


def _cell_stats(placed: DataFrame, keep: int) -> pd.DataFrame:
    """Per (group, cell): rows, widest radius and the ``keep`` smallest radii."""
    near = Window.partitionBy("g", "cell").orderBy("radius", "rep")
    smallest = (
        placed.withColumn("rn", F.row_number().over(near))
        .where(F.col("rn") <= keep)
        .groupBy("g", "cell")
        .agg(F.sort_array(F.collect_list("radius")).alias("smallest"))
    )
    sizes = placed.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("widest"))
    rows = sizes.join(smallest, ["g", "cell"]).collect()
    return pd.DataFrame({c: pd.Series([r[c] for r in rows], dtype=kind) for c, kind in _STATS.items()})


def _meeting_plan(placed: DataFrame, asked: DataFrame, pivots: np.ndarray, k: int, block_rows: int) -> dict:
    """Which point cells each query cell must meet, and from which radius on: numbers per pair of cells."""
    site_stats = _cell_stats(placed, k + 1)
    query_stats = site_stats if asked is placed else _cell_stats(asked, 1)
    between = np.sqrt(squared_distances(pivots, pivots))
    meetings = {}
    for g, theirs in query_stats.groupby("g"):
        ours = site_stats[site_stats["g"] == g]
        if not len(ours):
            continue
        cells = ours["cell"].to_numpy()
        for query in theirs.itertuples():
            apart = between[query.cell, cells]
            reach = np.concatenate(
                [query.widest + a + np.asarray(small) for a, small in zip(apart, ours["smallest"])]
            )
            bound = np.partition(reach, k)[k] if len(reach) > k else math.inf
            least = apart - query.widest - bound - 1e-9
            meets = ours["widest"].to_numpy() >= least
            blocks = max(1, math.ceil(query.n / block_rows))
            meetings[g, int(query.cell)] = (blocks, [
                (int(c), float(r), max(1, math.ceil(n / block_rows)))
                for c, r, n, yes in zip(cells, least, ours["n"], meets)
                if yes
            ])
    return meetings


def fresh(*names: str) -> list:
    """Columns under new identities: both sides of a self-join come from one table."""
    return [F.col(n).alias(n) for n in names]


def _bundles(sizes: dict[int, int], pivots: np.ndarray, most: int, first: int) -> tuple[dict[int, list[int]], int]:
    """Per cell of one group the bundles of its parts, numbered from ``first``, and the next free number.

    Cells near the same one of a few pivots are put side by side and the row of cells is cut into bundles
    of about ``most`` rows. A cell larger than that is a bundle for each of its parts.
    """
    cells = np.array(sorted(sizes))
    few = max(1, math.ceil(sum(sizes.values()) / most))
    at, d2 = nearest(pivots[cells], pivots[cells[:few]])
    homes, current, held = {}, first, 0
    for c in cells[np.lexsort((cells, d2, at))].tolist():
        parts = math.ceil(sizes[c] / most)
        if held and held + sizes[c] > most:
            current, held = current + 1, 0
        homes[c] = list(range(current, current + parts))
        current, held = (current, held + sizes[c]) if parts == 1 else (current + parts, 0)
    return homes, current + (held > 0)


def _meeting_tables(plan: dict, placed_sizes: dict, asked_sizes: dict, pivots: np.ndarray, most: int) -> tuple[list, list, int]:
    """Rows ``(group, cell, bundles of its parts, bundles to go to)`` of the queries and of the points.

    A point goes to a bundle of queries if its radius reaches the least that any cell of the bundle asks for.
    The last value is the number of meetings.
    """
    queries, points, meetings, free = [], [], set(), [0, 0]
    for g in {g: None for g, _ in plan}:
        asked_homes, free[0] = _bundles(asked_sizes[g], pivots, most, free[0])
        point_homes, free[1] = _bundles(placed_sizes[g], pivots, most, free[1])
        reach: dict[int, dict[int, float]] = {}
        for q, homes in asked_homes.items():
            goes = set()
            for c, least, _ in plan[g, q][1]:
                goes.update(point_homes[c])
                to = reach.setdefault(c, {})
                for b in homes:
                    to[b] = min(least, to.get(b, math.inf))
            queries.append((g, q, homes, sorted(goes)))
            meetings.update((q_home, home) for q_home in homes for home in goes)
        points += [(g, c, point_homes[c], sorted(to.items())) for c, to in reach.items()]
    return queries, points, len(meetings)


class _Asking:
    """The queries of one bundle and, of the points that have come past, the ``keep`` nearest of each.

    Order is (distance, first id), so the ``keep`` first vectors hold the ``keep`` first ids.
    """

    def __init__(self, queries: pa.Table, needs: dict, cells: int, keep: int, middle: np.ndarray):
        queries = queries.sort_by("cell").combine_chunks()
        self.g, self.rep = queries.column("g").combine_chunks(), queries.column("ids").combine_chunks().flatten()
        self.x, self.keep, self.middle = matrix(queries.column("x")).astype(float), keep, middle
        self.distance = np.full((len(self.x), keep), np.inf)
        self.site = np.full((len(self.x), keep), -1)
        # first ids and ids of the points that are among the nearest of a query, or were
        self.first, self.ids = None, []
        # how far a product of single precision can be off, as a share of the two squared lengths
        self.share = 8 * (self.x.shape[1] + 8) * float(np.finfo(np.float32).eps)
        self.blocks = []
        cell = queries.column("cell").to_numpy()
        group = self.g[0].as_py()
        for c in np.unique(cell):
            least = np.full(cells, np.inf)
            there, radius = needs.get((group, int(c)), ((), ()))
            least[list(there)] = radius
            begin, end = np.searchsorted(cell, c, "left"), np.searchsorted(cell, c, "right")
            for at in range(begin, end, BLOCK_ROWS):
                rows = slice(at, min(end, at + BLOCK_ROWS))
                self.blocks.append((least, rows, *self._centred(self.x[rows])))

    def _centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows about the middle with a column of ones, in single precision, and their squared lengths."""
        with np.errstate(over="ignore", invalid="ignore"):
            x0 = x - self.middle
            return np.hstack([x0, np.ones((len(x), 1))]).astype(np.float32), np.einsum("ij,ij->i", x0, x0)

    def meet(self, points: pa.Table) -> None:
        y = matrix(points.column("x")).astype(float)
        cell, radius = points.column("cell").to_numpy(), points.column("radius").to_numpy()
        ids = points.column("ids").combine_chunks()
        first = ids.values.take(ids.offsets[:-1]).to_numpy(zero_copy_only=False)
        base = 0 if self.first is None else len(self.first)
        first = first if self.first is None else np.concatenate([self.first, first])
        b, b2 = self._centred(y)
        with np.errstate(over="ignore", invalid="ignore"):
            b *= -2
            b[:, -1] = b2 * (1 - self.share)
        for least, rows, a, a2 in self.blocks:
            met = np.flatnonzero(radius >= least[cell])
            for at in range(0, len(met), STEP):
                # a slice is not copied
                some = met[at : at + STEP] if len(met) < len(y) else slice(at, at + STEP)
                row, site = self._near(rows, a, a2, y[some], b[some], b2[some])
                self._merge(rows.start + row, y, met[at + site], base, first)
        new = np.unique(self.site[self.site >= base])
        self._store(base, first, new, ids.take(pa.array(new - base)))

    def _near(self, rows: slice, a: np.ndarray, a2: np.ndarray, y: np.ndarray, b: np.ndarray, b2: np.ndarray):
        """Pairs (row of the block, row of ``y``) among which are all that are nearer than what is kept."""
        keep, x = self.keep, self.x[rows]
        bound = self.distance[rows, -1] ** 2 * (1 + 1e-12)
        if x.shape[1] > NARROW and 1e-15 < a2.max() + b2.max() < 1e30:
            # a squared distance less the most that it can be off, but for the query's own part
            less = a @ b.T
            if np.isinf(bound).any() and len(y) >= keep:
                more = less[:, : keep * 64] + (2 * self.share * b2[: keep * 64]).astype(np.float32)
                bound = np.minimum(bound, np.partition(more, keep - 1, axis=1)[:, keep - 1] + a2 * (1 + self.share))
            hit = less <= (bound - a2 * (1 - self.share)).astype(np.float32)[:, None]
            if np.count_nonzero(hit) <= MANY * keep * len(x):
                return np.divmod(np.flatnonzero(hit), len(y))
            bound = self.distance[rows, -1] ** 2 * (1 + 1e-12)
        d2, off = rough_squared_distances(x, y)
        if np.isinf(bound).any() and len(y) >= keep:
            kth = np.partition(d2, keep - 1, axis=1)[:, keep - 1] + off
            bound = np.fmin(bound, np.nan_to_num(kth * (1 + 1e-12), nan=np.inf, posinf=np.inf))
        return np.divmod(np.flatnonzero(d2 <= (bound + off)[:, None]), len(y))

    def _merge(self, row: np.ndarray, y: np.ndarray, at: np.ndarray, base: int, first: np.ndarray) -> None:
        parts = [slice(i, i + PAIRS) for i in range(0, len(row), PAIRS)]
        distance = np.sqrt(np.concatenate([np.empty(0), *(pair_distances(self.x[row[p]], y[at[p]]) for p in parts)]))
        good = distance <= self.distance[row, -1]
        row, site, distance = row[good], base + at[good], distance[good]
        if not len(row):
            return
        touched = np.unique(row)
        rows = np.concatenate([np.repeat(touched, self.keep), row])
        sites = np.concatenate([self.site[touched].ravel(), site])
        far = np.concatenate([self.distance[touched].ravel(), distance])
        there = sites >= 0
        rows, sites, far = rows[there], sites[there], far[there]
        tie = first[sites]
        tie = np.unique(tie, return_inverse=True)[1] if tie.dtype == object else tie
        order = np.lexsort((tie, far, rows))
        rows, sites, far = rows[order], sites[order], far[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = place < self.keep
        self.distance[touched], self.site[touched] = np.inf, -1
        self.distance[rows[kept], place[kept]] = far[kept]
        self.site[rows[kept], place[kept]] = sites[kept]

    def _store(self, base: int, first: np.ndarray, new: np.ndarray, ids: pa.Array) -> None:
        """Keep the new points that are among the nearest, and forget others once they are too many."""
        fresh_site = self.site >= base
        self.site[fresh_site] = base + np.searchsorted(new, self.site[fresh_site])
        self.first = np.concatenate([first[:base], first[new]])
        self.ids.append(ids)
        if len(self.first) > max(1 << 16, 2 * self.site.size):
            used = np.unique(self.site[self.site >= 0])
            self.site[self.site >= 0] = np.searchsorted(used, self.site[self.site >= 0])
            self.first, self.ids = self.first[used], [pa.concat_arrays(self.ids).take(pa.array(used))]

    def lists(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Per query with a point: the ``keep`` nearest ids, copies of a vector one by one."""
        ids = pa.concat_arrays(self.ids)
        offsets = ids.offsets.to_numpy()
        for at in range(0, len(self.x), 1 << 14):
            row, slot = np.nonzero(self.site[at : at + (1 << 14)] >= 0)
            row = row + at
            site, distance = self.site[row, slot], self.distance[row, slot]
            lengths = offsets[site + 1] - offsets[site]
            pair = np.repeat(np.arange(len(row)), lengths)
            place = np.arange(len(pair)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + offsets[site][pair]
            flat = pa.table({"row": row[pair], "distance": distance[pair], "id": ids.values.take(pa.array(place))})
            flat = flat.sort_by([("row", "ascending"), ("distance", "ascending"), ("id", "ascending")]).combine_chunks()
            row = flat.column("row").to_numpy()
            flat = flat.filter(pa.array(np.arange(len(row)) - np.searchsorted(row, row) < self.keep)).combine_chunks()
            row, begin = np.unique(flat.column("row").to_numpy(), return_index=True)
            if not len(row):
                continue
            kind = schema.field("near").type
            columns = [flat.column(i).combine_chunks().cast(kind.value_type.field(i - 1).type) for i in (1, 2)]
            items = pa.StructArray.from_arrays(columns, fields=list(kind.value_type))
            near = pa.ListArray.from_arrays(pa.array(np.append(begin, flat.num_rows), pa.int32()), items)
            found = [self.g.take(pa.array(row)), self.rep.take(pa.array(row)), near]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(found, schema)], schema=schema)


def _single(df: DataFrame) -> bool:
    """Whether no vector loses anything in single precision."""
    whole = F.col("x").cast("array<double>")
    kept = whole.eqNullSafe(F.col("x").cast("array<float>").cast("array<double>"))
    return df.agg(F.bool_and(kept)).first()[0] is not False


def _meet(placed: DataFrame, asked: DataFrame, plan: dict, pivots: np.ndarray, k: int, most: int) -> DataFrame:
    """Per query vector ``(g, rep, near)``: its k + 1 nearest ids, from points that stream past its bundle."""
    spark = placed.sparkSession
    kind = placed.schema["g"].dataType.simpleString()
    id_kind = placed.schema["rep"].dataType.simpleString()
    placed_sizes, asked_sizes = _sizes(placed), _sizes(asked) if asked is not placed else None
    query_rows, point_rows, _ = _meeting_tables(plan, placed_sizes, asked_sizes or placed_sizes, pivots, most)
    query_cells = spark.createDataFrame([r[:3] for r in query_rows], f"g {kind}, query_cell int, homes array<int>")
    point_cells = spark.createDataFrame(
        [(g, c, goes) for g, c, _, goes in point_rows], f"g {kind}, cell int, goes array<struct<qb: int, least: double>>"
    )
    # per query cell: the cells it meets, and from which radius on
    needs = {
        at: (np.array([c for c, _, _ in cells], np.int64), np.array([r for _, r, _ in cells])) for at, (_, cells) in plan.items()
    }
    shared, cells = spark.sparkContext.broadcast((needs, pivots.mean(axis=0))), len(pivots)
    spread = hash_int(hash_key("block", "rep"))
    home = F.get("homes", F.pmod(spread, F.size("homes")).cast("int"))
    exact = "array<float>" if _single(placed) and (asked is placed or _single(asked)) else "array<double>"

    def sent(part: int, *columns: Column) -> list[Column]:
        return [F.lit(part).alias("part"), *fresh("g"), *columns, F.col("x").cast(exact).alias("x")]

    points = (
        placed.join(F.broadcast(point_cells), ["g", "cell"])
        .withColumn("to", F.explode("goes"))
        .where(F.col("radius") >= F.col("to.least"))
        .select(F.col("to.qb").alias("qb"), *sent(1, *fresh("cell", "radius", "ids")))
    )
    queries = (
        asked.withColumnRenamed("cell", "query_cell")
        .join(F.broadcast(query_cells), ["g", "query_cell"])
        .select(home.alias("qb"), *sent(0, F.col("query_cell").alias("cell"), F.lit(0.0).alias("radius"), F.array("rep").alias("ids")))
    )
    bundles = 1 + max((b for r in query_rows for b in r[2]), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, waiting, asking, made = None, [], None, None
        for batch in batches:
            fields = batch.schema
            item = pa.struct([("distance", pa.float64()), ("id", fields.field("ids").type.value_type)])
            made = pa.schema([("g", fields.field("g").type), ("rep", item.field(1).type), ("near", pa.list_(item))])
            qb, part = batch.column("qb").to_numpy(), batch.column("part").to_numpy()
            ends = np.flatnonzero((np.diff(qb) != 0) | (np.diff(part) != 0)) + 1
            for begin, end in zip([0, *ends], [*ends, len(qb)]):
                if begin == end:
                    continue
                if qb[begin] != bundle:
                    if asking is not None:
                        yield from asking.lists(made)
                    bundle, waiting, asking = qb[begin], [], None
                rows = batch.slice(begin, end - begin)
                if part[begin] == 0:
                    waiting.append(rows)
                elif waiting or asking is not None:
                    if asking is None:
                        needs, middle = shared.value
                        asking, waiting = _Asking(pa.Table.from_batches(waiting), needs, cells, k + 1, middle), []
                    asking.meet(pa.Table.from_batches([rows]))
        if asking is not None:
            yield from asking.lists(made)

    return (
        queries.unionByName(points)
        .repartitionById(bundles, F.col("qb"))
        .sortWithinPartitions("qb", "part")
        .mapInArrow(run, f"g {kind}, rep {id_kind}, near array<struct<distance: double, id: {id_kind}>>")
    )


def _sizes(placed: DataFrame) -> dict:
    """Rows of every cell, per group."""
    sizes: dict = {}
    for r in placed.where("g IS NOT NULL").groupBy("g", "cell").count().collect():
        sizes.setdefault(r["g"], {})[r["cell"]] = r["count"]
    return sizes
