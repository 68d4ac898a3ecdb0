"""Set similarity join of documents on word n-grams: connected groups of near copies.

The join is the product of the document by n-gram incidence matrix with its transpose,
restricted by bounds on size and taken in blocks:

1. Documents with equal sets are one class from then on, whatever their ids.
2. Two sets that reach the wanted overlap share one of the first ``n - ceil(t n) + 1`` n-grams
   of each under any common order. The order is by hash, with n-grams of several classes last,
   so that a line or passage of many documents brings few of them together. Only these columns
   of the matrix are laid out.
3. All classes in a column meet at the column's smallest class. Distinct (meeting class,
   class) pairs are few: near copies share most columns, so they meet in few places.
4. At a meeting place, classes in order of size are cut into blocks of bounded weight, from counts by
   size, so that no task sorts a large place. Blocks
   whose sizes allow the overlap are multiplied, a stretch of columns at a time: first with
   the chosen columns only. Overlaps add up; a pair is dropped when its overlap there plus what
   the sizes still allow is too small, which ends nearly all pairs that share just a passage.
   What stays is brought together by groups, and multiplied over all columns in the same
   way. Of the links found, a spanning set leaves a task, never all pairs.
5. Links are contracted to components by alternating star steps on stored tables.

Keys that many rows share (a set of many copies, an n-gram of many texts, a size of many near copies, a
hub of many links) are joined where their rows lie (``common.join_groups``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycrest.llm.common import join_groups, small_batches
from tallycrest.session import materialize, scratch_scope

#: N-grams put last in the common order, at most; the order decides the cost, never the result.
MOST_COMMON = 1 << 20
COMMON_FROM = 3
#: Weight (n-grams) and number of classes of a block.
BLOCK_GRAMS = 1_500_000
BLOCK_ROWS = 1024
COLUMNS = 4096
#: Ids sent to all tasks to select documents (about 16 bytes each); above this many they are joined instead.
MOST_SENT = 500_000

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams (all words as one, if fewer)."""
    import xxhash

    split = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not split:
        return np.zeros(0, np.uint64)
    known: dict[bytes, int] = {}
    for w in set(split):
        known[w] = xxhash.xxh3_64_intdigest(w)
    hashes = np.fromiter(map(known.__getitem__, split), np.uint64, len(split))
    n = min(words, len(hashes))
    gram = np.full(len(hashes) - n + 1, 0x9E3779B97F4A7C15 + n, np.uint64)
    for i in range(n):
        gram = _mix(gram * np.uint64(0xD6E8FEB86659FD93) + hashes[i : len(gram) + i])
    return np.unique(gram)


def prefix_length(n: int, percent: int) -> int:
    """Columns of a set of ``n`` in which every set similar enough must appear."""
    return n + (-percent * n // 100) + 1 if n else 0


def known_length(n: int, percent: int) -> int:
    """Columns by which meeting sets are compared first: half as many again, for a closer bound."""
    most = prefix_length(n, percent)
    return most + most // 2 + 16


class _Common:
    """The common n-grams, sorted; membership of many at once."""

    def __init__(self, values: np.ndarray):
        self.values = values

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.values) or not len(grams):
            return np.zeros(len(grams), bool)
        at = np.minimum(np.searchsorted(self.values, grams), len(self.values) - 1)
        return self.values[at] == grams


def _most_common(classes: DataFrame) -> np.ndarray:
    """The n-grams to put last: those of ``COMMON_FROM`` classes or more, of which only the more
    frequent where they are above ``MOST_COMMON``. A bounded list; the result does not depend on it."""
    counted = materialize(
        classes.select(F.explode("low").alias("gram")).groupBy("gram").count().filter(F.col("count") >= COMMON_FROM),
        "jaccard-common",
    )
    total, least = 0, None
    for row in counted.groupBy("count").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("count")).toLocalIterator():
        total += row["n"]
        if total > MOST_COMMON:
            break
        least = row["count"]
    if least is None:
        return np.zeros(0, np.uint64)
    column = counted.filter(F.col("count") >= least).select("gram").toArrow().column("gram")  # 8 bytes a gram
    return np.sort(column.to_numpy().view(np.uint64))


def _longs(grams: np.ndarray) -> np.ndarray:
    return grams.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def mark_of(grams: np.ndarray) -> bytes:
    """Equal for equal sets."""
    from hashlib import blake2b

    return blake2b(grams.tobytes(), digest_size=16).digest()


def _profiles(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """row (unique), doc_id, n, mark (of the whole set) and the lowest n-grams, more than the prefix."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, marks, low = [], [], []
            for text in batch.column("text").to_pylist():
                grams = shingles(text, words)
                n = len(grams)
                sizes.append(n)
                marks.append(mark_of(grams))
                low.append(_longs(grams[: known_length(n, percent)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), _lists(low)],
                ["doc_id", "n", "mark", "low"],
            )

    found = docs.mapInArrow(profile, "doc_id long, n long, mark binary, low array<long>")
    # the numbers hold once they are stored
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "jaccard-profiles")


def _prefixes_from_low(profiles: DataFrame, common: np.ndarray, percent: int) -> DataFrame:
    """node, n, grams (first in the common order), and how many of them are uncommon.

    ``grams`` is null where too few of the lowest n-grams are uncommon to know the order's first.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_common = _Common(common)
        for batch in batches:
            lists = batch.column("low")
            flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.asarray(lists.offsets)
            hot = is_common(flat)
            out: list[np.ndarray | None] = []
            rares: list[int] = []
            for i, n in enumerate(batch.column("n").to_pylist()):
                low, bad = flat[ends[i] : ends[i + 1]], hot[ends[i] : ends[i + 1]]
                most = prefix_length(n, percent)
                rare = low[~bad]
                rares.append(len(rare))
                if len(low) == n:  # the whole set is here
                    out.append(_longs(np.concatenate([rare, low[bad]])))
                else:
                    out.append(_longs(rare) if len(rare) >= most else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "n")),
                    pa.array(out, pa.list_(pa.int64())),
                    pa.array(rares, pa.int32()),
                ],
                ["node", "n", "grams", "rare"],
            )

    return profiles.select("row", "n", "low").mapInArrow(
        choose, "node long, n long, grams array<long>, rare int"
    )


def _sets(docs: DataFrame, nodes: DataFrame, words: int, percent: int = 0, common: np.ndarray | None = None) -> DataFrame:
    """node, n, grams and rare of the classes ``nodes`` (node, doc_id, mark), read again from a document of each.

    The whole sets, or with ``common`` their first n-grams in the common order. One of each class, however
    often its document is repeated.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_common = _Common(np.zeros(0, np.uint64) if common is None else common)
        for batch in batches:
            sizes, out, rares, marks = [], [], [], []
            for text in batch.column("text").to_pylist():
                grams = shingles(text, words)
                bad = is_common(grams)
                sizes.append(len(grams))
                rares.append(int((~bad).sum()))
                marks.append(mark_of(grams))
                ordered = np.concatenate([grams[~bad], grams[bad]])
                out.append(_longs(ordered if common is None else ordered[: known_length(len(grams), percent)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.binary()), pa.array(sizes, pa.int64()), _lists(out), pa.array(rares, pa.int32())],
                ["mark", "n", "grams", "rare"],
            )

    nodes = materialize(nodes, "jaccard-wanted")
    given = _only(docs, nodes.select("doc_id").distinct(), "doc_id")
    found = given.mapInArrow(read, "mark binary, n long, grams array<long>, rare int")
    one = found.groupBy("mark").agg(F.first(F.struct("n", "grams", "rare")).alias("set"))
    return nodes.select("node", "mark").join(one, "mark").select("node", "set.*")


def _only(df: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """The rows whose ``key`` is in ``keys`` (or, with ``left_anti``, is not): the keys are sent to
    all tasks while their counted number is bounded, otherwise both sides are shuffled."""
    side = F.broadcast(keys) if keys.count() <= MOST_SENT else keys
    return df.join(side, key, how)


def linked(
    sizes: np.ndarray,
    extra: np.ndarray,
    present: np.ndarray,
    unseen: np.ndarray,
    owner: np.ndarray,
    place: np.ndarray,
    columns: int,
    percent: int,
    split: int,
) -> np.ndarray:
    """Boolean matrix of pairs of rows that are similar enough.

    ``owner`` and ``place`` are the row and column of each entry of the incidence matrix, in order
    of column; a row has ``extra`` more of its ``present`` entries that no other row shares.
    ``unseen``, by pair, is the most that the pair can share beyond the present entries. With
    ``split`` above 0 only pairs of a row before it and a row from it on count. Columns are taken
    a stretch at a time; overlaps add up, and a pair is dropped once the overlap so far plus what
    can still come is below what the two sizes need.
    """
    m = len(sizes)
    need = -(-percent * (sizes[:, None] + sizes[None, :]) // (100 + percent))  # 100 i >= percent (total - i)
    need = (need - unseen).astype(np.int32)
    left = (present - extra).astype(np.int32)
    live = np.minimum(left[:, None], left[None, :]) >= need
    if split:
        live[:split, :split] = False
        live[split:, split:] = False
    np.fill_diagonal(live, False)
    overlap = np.zeros((m, m), np.int32)
    rows = np.flatnonzero(live.any(axis=1))
    for start in range(0, columns, COLUMNS):
        if not len(rows):
            break
        low, high = np.searchsorted(place, [start, start + COLUMNS])
        who, column = owner[low:high], place[low:high] - start
        left -= np.bincount(who, minlength=m).astype(np.int32)
        block = np.zeros((m, min(COLUMNS, columns - start)), np.float32)
        block[who, column] = 1
        if split:  # only across the two blocks
            a, b = rows[rows < split], rows[rows >= split]
            product = (block[a] @ block[b].T).astype(np.int32)
            overlap[np.ix_(a, b)] += product
            overlap[np.ix_(b, a)] += product.T
        else:
            part = block[rows]
            overlap[np.ix_(rows, rows)] += (part @ part.T).astype(np.int32)
        live &= overlap + np.minimum(left[:, None], left[None, :]) >= need
        rows = np.flatnonzero(live.any(axis=1))
    return live


def spanning(live: np.ndarray) -> list[tuple[int, int]]:
    """Links that join each connected group of rows: (row, first row of its group)."""
    seen = np.zeros(len(live), bool)
    out = []
    for root in range(len(live)):
        if seen[root]:
            continue
        seen[root] = True
        queue = [root]
        while queue:
            new = np.flatnonzero(live[queue.pop()] & ~seen)
            seen[new] = True
            queue += new.tolist()
            out += [(int(x), root) for x in new]
    return out


def _unseen(sizes: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
    """By pair, the most that two rows can share beyond their present entries.

    ``places`` are each row's present entries in the common order, its first ones. Up to the
    smaller of two last entries both rows are wholly known; from there on each has what is left.
    """
    last = np.array([p[-1] for p in places])
    upto = np.stack([np.searchsorted(p, last, side="right") for p in places])  # row, the other's last entry
    rest = sizes[:, None] - upto
    return np.minimum(rest, rest.T)


def _unit_links(
    nodes: list[int], sides: list[int], sizes: list[int], rares: list[int], sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Spanning links among the rows of a unit; a set may hold only its first entries, ``rares`` before the common."""
    order = sorted(range(len(nodes)), key=lambda i: sides[i])
    nodes, sets = [nodes[i] for i in order], [sets[i].view(np.uint64) for i in order]
    split = sides.count(0) if any(sides) else 0
    if len(nodes) < 2 or any(sides) and not split:
        return []
    size = np.array([sizes[i] for i in order], np.int64)
    present = np.array([len(s) for s in sets], np.int64)
    grams = np.concatenate(sets)
    is_common = np.concatenate([np.arange(len(s)) >= rares[i] for i, s in zip(order, sets, strict=True)])
    owner = np.repeat(np.arange(len(sets)), present)
    by = np.lexsort((grams, is_common)) if is_common.any() else np.argsort(grams, kind="stable")
    grams, owner = grams[by], owner[by]
    place = np.cumsum(np.r_[False, grams[1:] != grams[:-1]])
    if (size == present).all():
        unseen = np.zeros((len(sets), len(sets)), np.int64)
    else:
        rows = np.argsort(owner, kind="stable")
        unseen = _unseen(size, np.split(place[rows], np.cumsum(present)[:-1]))
    # a column of one row adds to no overlap: it only lowers what the row can still gain
    several = np.bincount(place) > 1
    keep = several[place]
    extra = np.bincount(owner[~keep], minlength=len(sets))
    owner, place = owner[keep], (np.cumsum(several) - 1)[place[keep]]
    live = linked(size, extra, present, unseen, owner, place, int(several.sum()), percent, split)
    return [(nodes[a], nodes[b]) for a, b in spanning(live)]


def _product(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) from rows (place, left, right, side, node, n, rare, grams) sorted by unit."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, nodes, sides, sizes, rares, sets = None, [], [], [], [], []

        def links() -> pa.RecordBatch:
            found = _unit_links(nodes, sides, sizes, rares, sets, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in range(2)], ["a", "b"]
            )

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("place", "left", "right")), strict=True)
            lists = batch.column("grams")
            flat, ends = lists.values.to_numpy(zero_copy_only=False), np.asarray(lists.offsets)
            own, side, n, rare = (batch.column(c).to_pylist() for c in ("node", "side", "n", "rare"))
            for i, key in enumerate(keys):
                if key != unit:
                    if len(nodes) > 1:
                        yield links()
                    unit, nodes, sides, sizes, rares, sets = key, [], [], [], [], []
                nodes.append(own[i])
                sides.append(side[i])
                sizes.append(n[i])
                rares.append(rare[i])
                sets.append(flat[ends[i] : ends[i + 1]].copy())
        if len(nodes) > 1:
            yield links()

    columns = ("place", "left", "right", "side", "node", "n", "rare", "grams")
    return rows.select(*columns).mapInArrow(multiply, "a long, b long")


def _blocks(met: DataFrame, percent: int) -> DataFrame:
    """place, node, n, block: the classes of a place by size, cut at about the bounds of a block.

    Works on counts by place and size: a window sees one row for each size, and classes of one size that are too
    many for a block are dealt by hash. A class too far in size from all others is left out.
    """
    sizes = met.groupBy("place", "n").agg(F.count(F.lit(1)).alias("copies"))
    by_size = Window.partitionBy("place").orderBy("n")
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    n, copies = F.col("n"), F.col("copies")
    below, above = F.lag("n").over(by_size), F.lead("n").over(by_size)
    close = (copies > 1) | F.coalesce(100 * below >= percent * n, F.lit(False)) | F.coalesce(
        100 * n >= percent * above, F.lit(False)
    )
    cut = (
        sizes.withColumns({
            "close": close,
            "rows": F.coalesce(F.sum("copies").over(before), F.lit(0)),
            "grams": F.coalesce(F.sum(copies * n).over(before), F.lit(0)),
        })
        .filter("close")
        .select(
            "place", "n", "copies",
            F.expr(f"rows DIV {BLOCK_ROWS} + grams DIV {BLOCK_GRAMS}").alias("start"),
            F.greatest(F.ceil(copies / BLOCK_ROWS), F.ceil(copies * n / BLOCK_GRAMS)).alias("parts"),
        )
    )
    placed = join_groups(met, materialize(cut, "jaccard-sizes"), ["place", "n"])
    block = (F.col("start") + F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int")
    return materialize(placed.select("place", "node", "n", block.alias("block")), "jaccard-blocks")


def _multiplied(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the classes that share a ``place``. ``met`` (stored): place, node, n; ``sets``: node, grams, rare."""
    blocked = _blocks(met, percent)
    blocks = blocked.groupBy("place", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    units = (
        blocks.select("place", F.col("block").alias("left"), "high")
        .join(blocks.select("place", F.col("block").alias("right"), "low"), "place")
        .filter(f"left <= right AND 100 * high >= {percent} * low")
        .select("place", "left", "right")
    )
    firsts = units.join(blocked.withColumnRenamed("block", "left"), ["place", "left"]).withColumn("side", F.lit(0))
    seconds = (
        units.filter("left < right")
        .join(blocked.withColumnRenamed("block", "right"), ["place", "right"])
        .withColumn("side", F.lit(1))
    )
    rows = (
        firsts.unionByName(seconds)
        .join(sets, "node")
        .repartition("place", "left", "right")
        .sortWithinPartitions("place", "left", "right", "side")
    )
    return _product(rows, percent)


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``links`` (a, b).

    Alternating star steps: each node links its larger neighbours, then all its neighbours, to
    the smallest one. Every step is stored, so a lost executor repeats one step only.
    """
    least, most = F.least("a", "b"), F.greatest("a", "b")
    edges = materialize(links.select(most.alias("u"), least.alias("v")).filter("u > v").distinct(), "links")
    if not edges.take(1):
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))

    def with_smallest(pairs: DataFrame) -> DataFrame:
        smallest = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("copies"))
        return join_groups(pairs, materialize(smallest.withColumn("m", F.least("u", "m")), "links"), "u")

    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "links")
        small = with_smallest(large)
        centers = small.select("u", F.col("m").alias("v"))
        small = small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(centers)
        after = materialize(small.filter("u > v").distinct(), "links")
        # done when every node hangs on one root and no root hangs on another
        roots = after.select(F.col("v").alias("u")).distinct()
        if not after.join(roots, "u", "left_semi").take(1) and not after.groupBy("u").count().filter("count > 1").take(1):
            return after.select(F.col("u").alias("node"), F.col("v").alias("component"))
        edges = after


def _meetings(prefixes: DataFrame, percent: int) -> DataFrame:
    """place, node, n: the classes that share an n-gram meet at the smallest of them.

    An n-gram that is not among the common ones has few classes; a common one may have very many, so
    its place is an aggregate that joins the rows where they lie.
    """
    first = f"CAST(n - ({percent} * n + 99) DIV 100 + 1 AS INT)"  # prefix_length
    uncommon = prefixes.select("node", "n", F.explode(F.expr(f"slice(grams, 1, least(rare, {first}))")).alias("gram"))
    shared = materialize(
        prefixes.filter(f"rare < {first}").select(
            "node", "n", F.explode(F.expr(f"slice(grams, rare + 1, greatest({first} - rare, 0))")).alias("gram")
        ),
        "jaccard-shared",
    )
    column = Window.partitionBy("gram")
    few = (
        uncommon.withColumn("place", F.min("node").over(column))
        .withColumn("others", F.count(F.lit(1)).over(column))
        .filter("others > 1")
    )
    places = shared.groupBy("gram").agg(F.min("node").alias("place"), F.count(F.lit(1)).alias("copies"))
    many = join_groups(shared, materialize(places.filter("copies > 1"), "jaccard-places"), "gram")
    pairs = few.select("place", "node", "n").unionByName(many.select("place", "node", "n"))
    return materialize(pairs.groupBy("place", "node").agg(F.max("n").alias("n")), "jaccard-meetings")


def jaccard_rows(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """A stored table of one row for each row of ``docs``: doc_id, n, mark, component_id, and keep: true for one
    row of each group, one with its smallest doc_id, and for rows in no group. See ``jaccard_groups``."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with scratch_scope() as keep:
        return keep(_grouped(docs, words, percent), "jaccard-result")


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows of ``jaccard_rows``; reads stored tables that are deleted once the result is written."""
    profiles = _profiles(docs, words, percent)
    usable = profiles.filter("n > 0 AND doc_id IS NOT NULL").select("row", "doc_id", "n", "mark")
    # a class is known by the number of its row with the smallest id
    classes = materialize(
        usable.groupBy("mark").agg(
            F.min_by("row", "doc_id").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")
        ),
        "jaccard-classes",
    )
    rows = materialize(join_groups(usable, classes, "mark"), "jaccard-rows")
    repeats = rows.filter("row <> node").select("row")
    alone = _only(profiles.filter("n > 0 AND doc_id IS NOT NULL").select("row", "n", "low"), repeats, "row", "left_anti")
    common = _most_common(alone)
    chosen = materialize(_prefixes_from_low(alone, common, percent), "jaccard-prefixes")
    named = classes.select("node", F.col("least").alias("doc_id"), "mark")
    short = named.join(chosen.filter("grams IS NULL").select("node"), "node", "left_semi")
    others = materialize(_sets(docs, short, words, percent, common), "jaccard-prefixes")
    prefixes = chosen.filter("grams IS NOT NULL").unionByName(others)

    met = _meetings(prefixes, percent)
    likely = materialize(components(_multiplied(met, prefixes.select("node", "grams", "rare"), percent)), "jaccard-likely")
    roots = likely.select(F.col("component").alias("place")).distinct()
    together = likely.select(F.col("component").alias("place"), "node").unionByName(
        roots.select("place", F.col("place").alias("node"))
    )
    candidates = materialize(together.join(prefixes.select("node", "n"), "node"), "jaccard-candidates")
    sets = _sets(docs, named.join(candidates.select("node").distinct(), "node", "left_semi"), words)
    found = components(_multiplied(candidates, sets.select("node", "grams", "rare"), percent))

    rooted = classes.select("node", "least", "copies").join(found, "node", "left")
    rooted = materialize(rooted.withColumn("component", F.coalesce("component", "node")), "jaccard-rooted")
    groups = rooted.groupBy("component").agg(
        F.min("least").alias("component_id"), F.min_by("node", "least").alias("kept"), F.count(F.lit(1)).alias("copies")
    )
    placed = join_groups(rooted.select("node", "component"), materialize(groups, "jaccard-groups"), "component")
    placed = placed.join(rooted.select("node", "copies"), "node").select("node", "component_id", "kept", "copies")
    grouped = join_groups(rows, materialize(placed, "jaccard-placed"), "node").select(
        "doc_id", "n", "mark", "component_id", (F.col("row") == F.col("kept")).alias("keep")
    )
    apart = profiles.filter("n = 0 OR doc_id IS NULL").select(
        "doc_id", "n", "mark", F.col("doc_id").alias("component_id"), F.lit(True).alias("keep")
    )
    return grouped.unionByName(apart)


def jaccard_groups(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id: groups of documents joined by links of Jaccard >= percent/100.

    A document's set holds its distinct ``words``-grams of lower-cased (A-Z) words; with fewer
    words all of them as one. ``component_id`` is the smallest doc_id reachable by links. N-grams
    are compared by 64-bit hashes, so two pass wrongly as equal with a chance of 2**-64, and whole sets by
    128-bit ones.

    Null texts and texts without words have an empty set and link with nothing. Rows are linked, not ids: two
    texts under one doc_id are two documents, and repeated rows are given as often as they come. A row without
    doc_id is given with its size, a null component, and links with nothing. Other columns are not read. Bounds the
    session's Arrow batches (``small_batches``).
    """
    found = jaccard_rows(docs, words, percent)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``docs`` with one row of each group of ``jaccard_groups``: one with its smallest doc_id.

    Rows without an id, and texts without words, are in no group and stay. Of two texts under one doc_id
    each goes by its own group, and of rows that repeat a doc_id with an equal set one stays at most.
    """
    found = jaccard_rows(docs, words, percent)
    several = found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    several = materialize(several, "jaccard-several")
    gone = found.filter("NOT keep").select("doc_id").join(several, "doc_id", "left_anti")
    rest = _only(docs, materialize(gone, "jaccard-gone"), "doc_id", "left_anti")
    if not several.take(1):
        return rest.select(*docs.columns)
    # ids of several rows: rows are told apart by their sets
    kept = found.filter("keep AND n > 0").join(several, "doc_id", "left_semi").select("doc_id", "mark")
    repeated = _only(docs, several, "doc_id")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            marks = pa.array([mark_of(x) if len(x) else None for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], [*batch.schema.names, "_mark"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    told = repeated.select(*docs.columns).mapInArrow(marked, f"{fields}, _mark binary")
    first = Window.partitionBy("doc_id", "_mark").orderBy("doc_id")
    one = told.filter("_mark IS NOT NULL").withColumn("_nth", F.row_number().over(first)).filter("_nth = 1")
    one = one.join(kept.withColumnRenamed("mark", "_mark"), ["doc_id", "_mark"], "left_semi")
    without = told.filter("_mark IS NULL")
    others = _only(rest, several, "doc_id", "left_anti")
    return others.select(*docs.columns).unionByName(one.select(*docs.columns)).unionByName(without.select(*docs.columns))
