"""Exact nearest neighbours and distance summaries, without pairing all rows.

Points belong to the cell of their nearest pivot, as in the pivot methods for neighbour
joins (Lu, Shen, Chen and Ooi, VLDB 2012). Cells of more points than a block are split again
by pivots of their own, level by level, so the leaves stay small however large or
clustered the table is. A point first searches its own leaf; the distance found there then
rules out most other cells by the triangle inequality and by the plane between two pivots,
and the point is sent down to the rest only. Pivots below the first level are a table that
meets the points by cell; nothing on the driver grows with the points. Equal vectors are
one point, so a group of copies of any size costs one point. What meets at a leaf is cut
into blocks of bounded size, and a task holds one block of each side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycrest.session import materialize

BLOCK_ROWS = 8192
MAX_PIVOTS = 1024
#: Pivots of a cell that is split again, and how often that is done. (Each time parts at least the pivots.)
FANOUT = 64
MAX_DEPTH = 32
#: Rows of a table by cell that are sent to all tasks; above this many it is joined by a shuffle.
MOST_SENT = 100_000
HOT_SHARE = 1000
CHUNK = 512
#: Numbers that a worker holds in one array of distances, and in one batch of copied vectors.
CELLS_AT_ONCE = 1 << 18
NUMBERS_AT_ONCE = 1 << 20


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances between two small blocks, summed dimension by dimension."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        difference = a[:, j, None] - b[None, :, j]
        total += difference * difference
    return total


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def pieces(rows: int, columns: int, at_once: int) -> Iterator[slice]:
    """Slices of so many rows that a table of ``columns`` holds about ``at_once`` numbers."""
    step = max(1, at_once // max(1, columns))
    return (slice(start, min(start + step, rows)) for start in range(0, rows, step))


def nearest_pivot(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest pivot of each vector, and the distance to it."""
    place, radius = np.empty(len(vectors), dtype="int64"), np.empty(len(vectors))
    for part in pieces(len(vectors), len(pivots), CELLS_AT_ONCE):
        d = np.sqrt(squared_distances(vectors[part], pivots))
        place[part], radius[part] = d.argmin(axis=1), d.min(axis=1)
    return place, radius


def _equal_ids(own: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each own id the range of its equals in ``order``, an order of ``ids``; a null equals nothing."""
    codes = pd.factorize(np.concatenate([own, ids]))[0]
    mine, others = codes[: len(own)], codes[len(own) :]
    order = np.argsort(others, kind="stable")
    first = np.searchsorted(others[order], mine, "left")
    last = np.where(mine < 0, first, np.searchsorted(others[order], mine, "right"))
    return order, first, last


def nearest_in_block(
    own: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The k nearest vectors of other ids for each query: places of query and vector, and the squared distance.

    ``ids`` ascend, and the smaller one wins ties. One matrix product gives distances up to rounding; those that
    the rounding leaves in question are summed anew, dimension by dimension.
    """
    order, first, last = _equal_ids(own, ids)
    centre = vectors.mean(axis=0)
    with np.errstate(over="ignore", invalid="ignore"):
        a, b = queries - centre, vectors - centre
        a_norm, b_norm = (a * a).sum(axis=1), (b * b).sum(axis=1)
        finite = np.isfinite(a_norm).all() and np.isfinite(b_norm).all()
        slack = 2 * 8 * (a.shape[1] + 4) * np.finfo("float64").eps * (a_norm + b_norm.max())
    for part in pieces(len(queries), len(vectors), CELLS_AT_ONCE):
        if finite:
            d = a[part] @ b.T
            d *= -2
            d += b_norm
            d += a_norm[part, None]
        else:
            d = squared_distances(queries[part], vectors)
        begin, end = first[part], last[part]
        for nth in range(int((end - begin).max(initial=0))):
            rows = np.flatnonzero(begin + nth < end)
            d[rows, order[begin[rows] + nth]] = np.inf
        rows = np.arange(len(d))
        picked, values = [], []
        for _ in range(min(k, len(vectors))):
            best = d.argmin(axis=1)  # the smaller id wins ties
            picked.append(best)
            values.append(d[rows, best])
            d[rows, best] = np.inf
        if finite:
            limit = values[-1] + slack[part]
            # a row of fewer than k others picks a place again, with infinity, and has an infinite limit
            for best, value in zip(reversed(picked), reversed(values)):
                d[rows, best] = value
            q, c = np.nonzero((d <= limit[:, None]) & (d < np.inf))
            exact = np.zeros(len(q))
            for j in range(queries.shape[1]):
                difference = queries[part][q, j] - vectors[c, j]
                exact += difference * difference
            by = np.lexsort((c, exact, q))
            q, c, exact = q[by], c[by], exact[by]
            kept = np.arange(len(q)) - np.searchsorted(q, q) < k
            yield q[kept] + part.start, c[kept], exact[kept]
        else:
            for best, value in zip(picked, values):
                hit = np.isfinite(value)
                yield rows[hit] + part.start, best[hit], value[hit]


def join_on_vector(rows: DataFrame, table: DataFrame, total: int) -> DataFrame:
    """Join rows to their distinct vector in ``table`` (columns ``features``, ``copies``...).

    Vectors with more than 1/HOT_SHARE of all rows number fewer than HOT_SHARE, so they
    are broadcast; the rest is joined by a shuffle in which no key is hot.
    """
    limit = total / HOT_SHARE
    hot = table.filter(F.col("copies") > limit)
    rest = table.filter(F.col("copies") <= limit)
    on_hot = rows.join(F.broadcast(hot), "features")
    others = rows.join(F.broadcast(hot.select("features")), "features", "left_anti")
    return on_hot.unionByName(others.join(rest, "features"))


def distinct_points(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: copies and its ``keep`` smallest ids with their classes.

    The filter on the row number is applied before the shuffle as well, so copies of one
    vector do not meet in a task.
    """
    order = Window.partitionBy("features").orderBy("id")
    first = (
        rows.withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= keep)
        .groupBy("features")
        .agg(F.array_sort(F.collect_list(F.struct("id", "class"))).alias("members"))
    )
    counts = rows.groupBy("features").agg(F.count(F.lit(1)).alias("copies"))
    return first.join(counts, "features").withColumn("point", F.col("members")[0]["id"])


def _assign_cells(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the cell (the place of the nearest pivot, as text) and the distance to its pivot."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                place, radius = nearest_pivot(stacked(batch["features"]), pivots)
                yield batch.assign(cell=place.astype(str), radius=radius)

    schema = f"{points.schema.simpleString()[7:-1]}, cell: string, radius: double"
    return points.mapInPandas(assign, schema)


def _sent(table: DataFrame) -> DataFrame:
    """``table`` for a join by cell: sent to all tasks while its counted rows are few."""
    return F.broadcast(table) if table.count() <= MOST_SENT else table


def _sliced(rows: DataFrame, pivots: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows of each cell in slices of about ``block_rows``, and the cell's pivots for every slice."""
    sizes = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("slices"))
    sizes = materialize(sizes, "cell-slices")
    side = _sent(sizes)
    dealt = rows.join(side, "cell").withColumn("slice", F.pmod(F.xxhash64("point"), F.col("slices")).cast("int"))
    copied = pivots.join(sizes, "cell").withColumn("slice", F.explode(F.expr("sequence(0, slices - 1)")))
    return dealt.drop("slices"), copied.drop("slices")


def _split_cells(cells: DataFrame, block_rows: int, fanout: int) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves (point, features, cell, radius) of at most ``block_rows`` points, and for each round of splitting
    the new cells: their parent ``cell``, ``child``, pivot vector and the smallest and largest distance to it."""
    kind = cells.schema["point"].dataType.simpleString()
    levels: list[DataFrame] = []
    while len(levels) < MAX_DEPTH:
        large = cells.groupBy("cell").count().filter(F.col("count") > block_rows).select("cell")
        large = materialize(large, "large-cells")
        if not large.take(1):
            break
        side = _sent(large)
        inside = materialize(cells.join(side, "cell", "left_semi").select("point", "features", "cell"), "split-points")
        by_hash = Window.partitionBy("cell").orderBy(F.xxhash64("point"), "point")
        pivots = materialize(
            inside.withColumn("nth", F.row_number().over(by_hash)).filter(F.col("nth") <= fanout)
            .select("cell", "nth", F.col("features").alias("pivot")),
            "split-pivots",
        )
        rows, copied = _sliced(inside, pivots, block_rows)

        def assign(points: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
            if not len(points):
                return pd.DataFrame({"point": [], "features": [], "cell": [], "radius": []})
            around = around.sort_values("nth")
            place, radius = nearest_pivot(stacked(points["features"]), stacked(around["pivot"]))
            nearest = around["nth"].to_numpy()[place]
            return pd.DataFrame({
                "point": points["point"].to_numpy(), "features": points["features"].to_numpy(),
                "cell": points["cell"].to_numpy() + "/" + nearest.astype(str), "radius": radius,
            })

        keys = ["cell", "slice"]
        children = materialize(
            rows.groupBy(*keys).cogroup(copied.groupBy(*keys))
            .applyInPandas(assign, f"point {kind}, features array<double>, cell string, radius double"),
            "split-cells",
        )
        child = F.concat_ws("/", "cell", F.col("nth").cast("string"))
        radii = children.groupBy(F.col("cell").alias("child")).agg(F.min("radius").alias("low"), F.max("radius").alias("high"))
        levels.append(materialize(pivots.withColumn("child", child).join(radii, "child"), "split-nodes"))
        rest = cells.join(side, "cell", "left_anti").select("point", "features", "cell", "radius")
        cells = materialize(rest.unionByName(children), "cells")
    return cells, levels


def _cell_radii(cells: DataFrame, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest distance from each first pivot to a point of its cell (one row per pivot)."""
    low, high = np.full(pivots, np.inf), np.full(pivots, -np.inf)
    for cell, least, most in cells.groupBy("cell").agg(F.min("radius"), F.max("radius")).collect():
        low[int(cell)], high[int(cell)] = least, most
    return low, high


def _within_reach(
    vectors: np.ndarray, bound: np.ndarray, pivots: np.ndarray, low: np.ndarray, high: np.ndarray, apart: np.ndarray
) -> np.ndarray:
    """Which cells (columns) may hold a point within the bound of each vector (rows). ``apart`` has the distances
    between the pivots."""
    squared = squared_distances(vectors, pivots)
    d = np.sqrt(squared)
    nearest = d.argmin(axis=1)
    rows = np.arange(len(vectors))
    reach = bound[:, None] * (1 + 1e-9) + 1e-9 * (1 + d)
    gap = apart[nearest]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(gap > 0, (squared - squared[rows, nearest][:, None]) / (2 * gap), -np.inf)
    return (d - high <= reach) & (low - d <= reach) & (plane <= reach)


def _copies_by_cell(
    queries: pd.DataFrame, pivots: np.ndarray, names: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[pd.DataFrame]:
    """The queries once for each cell within their reach, in batches of bounded size however many cells that are."""
    vectors, bound = stacked(queries["features"]), queries["bound"].to_numpy()
    apart = np.sqrt(squared_distances(pivots, pivots))
    most = max(1, NUMBERS_AT_ONCE // vectors.shape[1])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def copies() -> Iterator[pd.DataFrame]:
        which, cell = (np.concatenate(side) for side in zip(*found))
        for part in pieces(len(which), 1, most):
            picked = queries.iloc[which[part]]
            yield picked[["point", "features", "home", "bound"]].assign(cell=names[cell[part]])

    for part in pieces(len(vectors), len(pivots), CELLS_AT_ONCE):
        which, cell = np.nonzero(_within_reach(vectors[part], bound[part], pivots, low, high, apart))
        found.append((which + part.start, cell))
        waiting += len(which)
        if waiting >= most:
            yield from copies()
            found, waiting = [], 0
    if waiting:
        yield from copies()


def _send_to_cells(
    queries: DataFrame, pivots: np.ndarray, radii: tuple[np.ndarray, np.ndarray], levels: list[DataFrame],
    block_rows: int,
) -> DataFrame:
    """Copy each query to the other leaves that may hold a point within its ``bound``."""
    low, high = radii
    kind = queries.schema["point"].dataType.simpleString()
    schema = f"point {kind}, features array<double>, home string, bound double, cell string"

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = np.arange(len(pivots)).astype(str).astype(object)
        for batch in batches:
            if len(batch):
                yield from _copies_by_cell(batch, pivots, names, low, high)

    def send_down(queries: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(nodes):
            return queries.iloc[:0][["point", "features", "home", "bound", "cell"]]
        limits = (nodes[c].to_numpy()[None, :] for c in ("low", "high"))
        parts = list(_copies_by_cell(queries, stacked(nodes["pivot"]), nodes["child"].to_numpy(), *limits))
        return pd.concat(parts) if parts else queries.iloc[:0][["point", "features", "home", "bound", "cell"]]

    waiting = queries.withColumnRenamed("cell", "home").mapInPandas(send, schema)
    away = None
    for nodes in levels:
        waiting = materialize(waiting, "sent-down")
        split = _sent(materialize(nodes.select("cell").distinct(), "split-parents"))
        at_leaf = waiting.join(split, "cell", "left_anti").select("point", "features", "home", "bound", "cell")
        away = at_leaf if away is None else away.unionByName(at_leaf)
        # a cell that is split further on stays in ``waiting`` until its round
        going = waiting.join(split, "cell", "left_semi")
        rows, copied = _sliced(going, nodes.select("cell", "child", "pivot", "low", "high"), block_rows)
        keys = ["cell", "slice"]
        waiting = rows.groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInPandas(send_down, schema)
    away = waiting if away is None else away.unionByName(waiting)
    return away.filter(F.col("cell") != F.col("home")).select("point", "features", "cell")


def _search(queries: DataFrame, candidates: DataFrame, k: int, block_rows: int) -> DataFrame:
    """The k best points per query and block pair, from tiles of bounded size. Both sides are stored tables."""
    sizes = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("qblocks")).join(
        candidates.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("cblocks")), "cell"
    )
    side = _sent(materialize(sizes, "cell-blocks"))

    # new column identities: both sides of the cogroup may come from one table
    def spread(df: DataFrame, own: str, other: str) -> DataFrame:
        return (
            df.join(side, "cell")
            .withColumn(f"{own}block", F.pmod(F.xxhash64("point"), F.col(f"{own}blocks")).cast("int"))
            .withColumn(f"{other}block", F.explode(F.expr(f"sequence(0, {other}blocks - 1)")))
            .drop("qblocks", "cblocks")
        )

    keys = ["cell", "qblock", "cblock"]
    kind = candidates.schema["point"].dataType.simpleString()
    ids_type = "object" if kind == "string" else "int64"
    left = spread(queries.select("point", "features", "cell"), "q", "c")
    renamed = candidates.select(*[F.col(c).alias(c) for c in ("point", "features", "cell")])
    right = spread(renamed, "c", "q")

    def tile(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = {"point": [], "other": [], "squared": []}
        if len(q) and len(c):
            c = c.sort_values("point")
            own, ids = q["point"].to_numpy(), c["point"].to_numpy()
            for which, other, squared in nearest_in_block(own, stacked(q["features"]), ids, stacked(c["features"]), k):
                found["point"].append(own[which])
                found["other"].append(ids[other])
                found["squared"].append(squared)
        return pd.DataFrame(
            {n: np.concatenate(v) if v else np.array([], dtype="float64" if n == "squared" else ids_type)
             for n, v in found.items()}
        )

    return (
        left.groupBy(*keys).cogroup(right.groupBy(*keys))
        .applyInPandas(tile, f"point {kind}, other {kind}, squared double")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k smallest distances per query; the smaller id wins ties."""
    order = Window.partitionBy("point").orderBy("squared", "other")
    return found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def nearest_neighbours(
    rows: DataFrame,
    key: str,
    features: str,
    payload: str,
    k: int,
    wanted: Column | None = None,
    block_rows: int = BLOCK_ROWS,
    max_pivots: int = MAX_PIVOTS,
    fanout: int = FANOUT,
) -> DataFrame:
    """The k nearest other rows of each row: ``key`` and ``neighbours``, an array of
    (squared, id, class) ascending; ties go to the smaller id.

    ``key`` is any type with an order; ``wanted`` limits for which rows neighbours are searched.
    Fitting the pivots and bounds runs jobs at once; intermediate tables go to the shared
    scratch folder.
    """
    named = rows.select(
        F.col(key).alias("id"), F.col(features).alias("features"), F.col(payload).alias("class"),
        (F.lit(True) if wanted is None else wanted).alias("wanted"),
    )
    points = materialize(distinct_points(named, k + 1), "points")
    total, distinct = points.agg(F.sum("copies"), F.count(F.lit(1))).first()
    total = total or 0
    # Vectors with more than k copies have their neighbours among the copies.
    crowd = points.filter(F.col("copies") > k)
    near = F.slice(
        F.transform(
            F.filter("members", lambda m: m["id"] != F.col("id")),
            lambda m: F.struct(F.lit(0.0).alias("squared"), m["id"].alias("id"), m["class"].alias("class")),
        ), 1, k,
    )
    in_crowd = join_on_vector(
        named.filter("wanted").select("id", "features"), crowd.select("features", "copies", "members"), total
    ).select("id", near.alias("neighbours"))

    few = points.filter(F.col("copies") <= k)
    wanted_ids = named.filter("wanted").select("id")
    singles = few.select("point", "features", F.explode("members").alias("member")).select(
        "point", F.col("member")["id"].alias("id")
    ).join(wanted_ids, "id", "left_semi")
    # cells of half a block: smaller ones rule out little more, and where nothing is ruled out
    # each vector is copied to all cells
    pivot_count = max(1, min(max_pivots, math.isqrt(distinct or 1), math.ceil(2 * (distinct or 1) / block_rows)))
    pivot_rows = points.orderBy(F.xxhash64("point"), "point").limit(pivot_count).select("features").collect()
    if not pivot_rows:
        return in_crowd.withColumnRenamed("id", key)
    pivots = np.array([r[0] for r in pivot_rows], dtype="float64")
    top = materialize(_assign_cells(points.select("point", "features"), pivots), "cells")
    cells, levels = _split_cells(top, block_rows, fanout)
    queries = cells.join(singles.select("point").distinct(), "point", "left_semi")
    queries = materialize(queries.select("point", "features", "cell"), "queries")
    near_home = materialize(_search(queries, cells, k, block_rows), "near-home")
    reach = _best(near_home, k).groupBy("point").agg(
        F.when(F.count(F.lit(1)) == k, F.sqrt(F.max("squared"))).alias("bound")
    )
    bounded = queries.join(reach, "point", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    sent = _send_to_cells(bounded, pivots, _cell_radii(top, len(pivots)), levels, block_rows)
    away = materialize(sent, "away")
    best = _best(near_home.unionByName(_search(away, cells, k, block_rows)), k)
    members = points.select(F.col("point").alias("other"), F.col("members").alias("others"))
    listed = (
        best.join(members, "other")
        .select("point", F.explode("others").alias("m"), "squared")
        .groupBy("point")
        .agg(F.collect_list(F.struct("squared", F.col("m")["id"].alias("id"), F.col("m")["class"].alias("class")))
             .alias("away"))
    )
    copies = F.transform(
        F.filter("members", lambda m: m["id"] != F.col("id")),
        lambda m: F.struct(F.lit(0.0).alias("squared"), m["id"].alias("id"), m["class"].alias("class")),
    )
    searched = (
        singles.join(few.select("point", "members"), "point")
        .join(listed, "point", "left")
        .select(
            "id",
            F.slice(F.array_sort(F.concat(copies, F.coalesce("away", F.array()))), 1, k).alias("neighbours"),
        )
    )
    return in_crowd.unionByName(searched).withColumnRenamed("id", key)


def undersample(
    df: DataFrame,
    key: str,
    features: str,
    label: str,
    mode: str = "reference",
    max_share: float = 0.6,
    **search,
) -> DataFrame:
    """Thin out the majority class near the class border, if its share exceeds ``max_share``.

    ``reference`` drops majority rows whose second nearest other row is of the other
    class; ``tomek`` drops the majority row of each pair of mutual nearest rows of
    different classes. All other rows stay.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().limit(3).collect()}
    if len(counts) > 2:
        raise ValueError(f"{label} must have two classes")
    majority = max(sorted(counts), key=lambda c: counts[c], default=None)
    if majority is None or counts[majority] <= max_share * sum(counts.values()):
        return df
    if mode == "reference":
        found = nearest_neighbours(df, key, features, label, 2, F.col(label) == majority, **search)
        second = F.get("neighbours", F.lit(1))
        dropped = found.filter(second["class"] != majority).select(key)
    elif mode == "tomek":
        found = nearest_neighbours(df, key, features, label, 1, **search)
        first = F.get("neighbours", F.lit(0))
        pairs = found.select(
            F.least(key, first["id"]).alias("a"), F.greatest(key, first["id"]).alias("b"),
            F.when(first["class"] == majority, first["id"]).alias("major"), first["class"].alias("class"),
        )
        dropped = (
            pairs.groupBy("a", "b")
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("class").alias("classes"), F.max("major").alias(key))
            .filter((F.col("n") == 2) & (F.col("classes") == 2))
            .select(key)
        )
    else:
        raise ValueError(f"unknown mode {mode}")
    return df.join(dropped, key, "left_anti")


def error_distance(
    df: DataFrame, key: str, features: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Smallest and mean distance of each wrong prediction to all correct ones.

    The mean needs every distance, so the work is wrong x correct distinct vectors; each
    task reduces one block pair to a row per wrong vector, and no pair is written.
    """
    right = F.col("target_encoded") == F.col("predictions")
    rows = df.select(F.col(key), F.col(features).alias("features"), right.alias("right"))
    vectors = materialize(
        rows.groupBy("features").agg(
            F.count_if("right").alias("correct"), F.count_if(~F.col("right")).alias("copies"),
            F.min(key).alias("point"),
        ),
        "vectors",
    )
    total, wrong_points, right_points = vectors.agg(
        F.sum("copies"), F.count_if(F.col("copies") > 0), F.count_if(F.col("correct") > 0)
    ).first()
    kind = vectors.schema["point"].dataType.simpleString()
    q_blocks = max(1, math.ceil(wrong_points / block_rows))
    c_blocks = max(1, math.ceil(right_points / block_rows))
    place = F.xxhash64("point")
    left = vectors.filter("copies > 0").select(
        "point", "features", F.pmod(place, F.lit(q_blocks)).cast("int").alias("qblock"),
        F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("cblock"),
    )
    # new column names: both sides of the cogroup come from one table
    other = vectors.filter("correct > 0").select(
        F.col("features").alias("vector"), F.col("correct").alias("weight"), F.pmod(place, F.lit(c_blocks)).cast("int").alias("cblock"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qblock"),
    )

    def tile(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(q) and len(c):
            vectors, weight = stacked(c["vector"]), c["weight"].to_numpy()
            for start in range(0, len(q), CHUNK):
                part = q.iloc[start : start + CHUNK]
                d = np.sqrt(squared_distances(stacked(part["features"]), vectors))
                parts.append(pd.DataFrame({
                    "point": part["point"].to_numpy(), "n": int(weight.sum()),
                    "nearest": d.min(axis=1), "total": d @ weight,
                }))
        empty = pd.DataFrame({"point": pd.Series(dtype="object" if kind == "string" else "int64"), "n": pd.Series(dtype="int64"),
                              "nearest": pd.Series(dtype="float64"), "total": pd.Series(dtype="float64")})
        return pd.concat(parts) if parts else empty

    summary = (
        left.groupBy("qblock", "cblock").cogroup(other.groupBy("qblock", "cblock"))
        .applyInPandas(tile, f"point {kind}, n long, nearest double, total double")
        .groupBy("point")
        .agg(F.sum("n").alias("n_correct"), F.min("nearest").alias("min_distance"),
             (F.sum("total") / F.sum("n")).alias("avg_distance"))
    )
    known = vectors.filter("copies > 0").select("features", "copies", "point").join(summary, "point").drop("point")
    wrong = rows.filter(~F.col("right")).select(key, "features")
    return join_on_vector(wrong, known, total or 0).select(key, "n_correct", "min_distance", "avg_distance")
