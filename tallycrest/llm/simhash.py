"""SimHash near copies: fingerprints within a few bits of each other, found by pivot distance tables.

1. A text's fingerprint has the majority bits of the hashes of its word shingles. Equal fingerprints are one
   point from then on.
2. A point's row in the pivot table holds its Hamming distances to ``PIVOTS`` reference fingerprints, tabled
   by stretches of bits; over all stretches they add up to the distances to the whole references.
3. Two points within ``limit`` bits differ at no more than ``limit`` stretches, so on the rest of them all
   their coordinates are equal: the largest coordinate difference there is 0. With ``STRETCHES`` stretches, every
   choice of ``STRETCHES - limit`` of them is a key, made from the coordinates on these stretches, under
   which such points meet. (Whole references alone cannot part the points: distances of unlike fingerprints to
   any reference are 32 give or take 4, hardly more apart than the limit.)
4. Points that meet are compared by whole coordinates: a pair whose distances to one reference differ by
   more than ``limit`` cannot be within it (triangle inequality) and is discarded. The survivors are verified by
   their differing bits.
5. Points of a task that are joined already are not compared again, and a task gives a spanning set of its links,
   never all pairs. Links are contracted to components on stored tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycrest.llm.common import join_groups, small_batches
from tallycrest.llm.jaccard import components
from tallycrest.session import materialize, scratch_scope

BITS = 64
SEED = 42
#: References of the pivot table, and stretches of bits that their distances are tabled by.
PIVOTS = 16
STRETCHES = 6
#: Points of one key that a task compares at once; larger keys are cut into pairs of parts.
PART = 4096
#: Keys above ``PART`` points that are sent to all tasks; above this many they are joined instead.
MOST_SENT = 100_000
#: Points read before a worker compares them (whole keys).
WORKER_ROWS = 200_000

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str | None, words: int = 4) -> int:
    """Majority bits of the XXH64 of all word shingles (all words as one, if fewer); 0 without words."""
    import xxhash

    split = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not split:
        return 0
    line = b" ".join(split)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = min(words, len(split))
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(split) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in cuts), np.uint64, len(split) - n + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        some = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += some.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def references() -> np.ndarray:
    """The reference fingerprints: a fixed row of mixed numbers."""
    return _mix(np.arange(1, PIVOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def stretch_masks(stretches: int) -> np.ndarray:
    """The bits of each stretch."""
    at = np.linspace(0, BITS, stretches + 1).round().astype(int)
    return np.array([(1 << b) - (1 << a) for a, b in zip(at[:-1], at[1:], strict=True)], np.uint64)


def pivot_table(points: np.ndarray, masks: np.ndarray | None = None) -> np.ndarray:
    """Distances (point, reference) to the whole references, or by stretch (point, stretch, reference)."""
    apart = points[:, None] ^ references()[None, :]
    if masks is None:
        return np.bitwise_count(apart)
    return np.bitwise_count(apart[:, None, :] & masks[None, :, None])


def meeting_keys(points: np.ndarray, limit: int, stretches: int) -> np.ndarray:
    """Keys (point, choice): equal for two points, on a choice of stretches, if all coordinates there are.

    The coordinates of a stretch are mixed to 64 bits; a chance equality only adds a meeting.
    """
    coordinates = pivot_table(points, stretch_masks(stretches))
    rows = np.ascontiguousarray(coordinates).view(np.uint64)  # 8 coordinates a number
    own = np.zeros(rows.shape[:2], np.uint64)
    for i in range(rows.shape[2]):
        own = _mix(own * np.uint64(0xD6E8FEB86659FD93) + rows[:, :, i] + np.uint64(i + 1))
    keys = []
    for k, chosen in enumerate(combinations(range(stretches), stretches - limit)):
        key = np.full(len(points), k + 1, np.uint64)
        for i in chosen:
            key = _mix(key * np.uint64(0xD6E8FEB86659FD93) + own[:, i])
        keys.append(key)
    return np.stack(keys, axis=1)


def _merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (the first member of each row's group) once the groups of ``a`` and ``b`` are joined."""
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]


def near_links(points: np.ndarray, group: np.ndarray, side: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (row, row) among rows of equal ``group``, rows being in order of group.

    Rows of side 0 and 1 are compared with each other; a group of side 0 only is compared within.
    """
    n = len(points)
    table = pivot_table(points).T.astype(np.int8)
    starts = np.r_[0, np.flatnonzero(group[1:] != group[:-1]) + 1] if n else np.zeros(0, np.int64)
    length = np.diff(np.r_[starts, n])
    left = np.repeat(starts + length, length) - np.arange(n)  # rows from here to the end of the group
    two_sided = np.repeat(np.add.reduceat(side, starts) > 0, length) if n else np.zeros(0, bool)
    root = np.arange(n)
    rows = np.arange(n)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(1, int(length.max(initial=1))):
        rows = rows[left[rows] > k]
        a, b = rows, rows + k
        fit = (root[a] != root[b]) & (~two_sided[a] | (side[a] != side[b]))
        a, b = a[fit], b[fit]
        for distances in table:
            close = np.abs(distances[a] - distances[b]) <= limit
            a, b = a[close], b[close]
        near = np.bitwise_count(points[a] ^ points[b]) <= limit
        if near.any():
            found.append((a[near], b[near]))
        if found and (k & (k - 1) == 0 or sum(len(x) for x, _ in found) > 1 << 14):
            root, found = _merged(root, *map(np.concatenate, zip(*found, strict=True))), []
    if found:
        root = _merged(root, *map(np.concatenate, zip(*found, strict=True)))
    joined = np.flatnonzero(root != np.arange(n))
    return joined, root[joined]


def _compared(rows: DataFrame, limit: int) -> DataFrame:
    """Links (a, b) of rows (unit, side, point) that a task holds in order of unit."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def links(unit: np.ndarray, side: np.ndarray, point: np.ndarray) -> pa.RecordBatch:
            group = np.r_[0, np.cumsum((unit[1:] != unit[:-1]).any(axis=1))] if len(unit) else np.zeros(0, np.int64)
            a, b = near_links(point.view(np.uint64), group, side, limit)
            return pa.RecordBatch.from_arrays([pa.array(point[a]), pa.array(point[b])], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "left", "right", "side", "point")]
            held.append((np.stack(columns[:3], axis=1), columns[3], columns[4]))
            count += len(columns[0])
            if count < WORKER_ROWS:
                continue
            unit, side, point = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int((unit != unit[-1]).any(axis=1).nonzero()[0].max(initial=-1)) + 1  # the last unit may go on
            yield links(unit[:last], side[:last], point[:last])
            held = [(unit[last:], side[last:], point[last:])]
            count = len(unit) - last
        if held:
            yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))

    ordered = rows.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "side")
    return ordered.mapInArrow(compare, "a long, b long")


def near_pairs(points: DataFrame, limit: int = 4, stretches: int = STRETCHES) -> DataFrame:
    """Links (a, b) that join all points (column ``point``, distinct longs) with ``limit`` or fewer differing bits."""
    if not 0 <= limit < stretches:
        raise ValueError("more stretches than differing bits are needed")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            point = batch.column("point").to_numpy(zero_copy_only=False)
            keys = meeting_keys(point.view(np.uint64), limit, stretches)
            arrays = [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(point, keys.shape[1]))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "point"])

    met = points.select("point").mapInArrow(keyed, "key long, point long")
    sizes = met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(f"n > {PART}")
    large = materialize(sizes.select("key", F.expr(f"CAST((n + {PART} - 1) DIV {PART} AS INT)").alias("parts")), "simhash-large")
    side = F.broadcast(large) if large.count() <= MOST_SENT else large
    parted = met.join(side, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.expr("CAST(pmod(xxhash64(point, 7), parts) AS INT)")
    units = parted.withColumn("own", own).select(
        "key", "point", "own", F.explode(F.expr("sequence(0, parts - 1)")).alias("other")
    )
    rows = units.select(
        "key",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "point",
    )
    return _compared(rows, limit)


def simhash_groups(docs: DataFrame, words: int = 4, limit: int = 4, stretches: int = STRETCHES) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: groups of documents joined by near fingerprints.

    Fingerprints link at ``limit`` or fewer differing bits; ``component_id`` is the smallest doc_id reachable.
    More ``stretches`` make more keys of fewer points each, with the same result.

    Null texts and texts without words have fingerprint 0, which links like any other. Rows are linked, not ids:
    two texts under one doc_id stay apart unless their fingerprints are joined; repeated rows are given
    as often as they come. A row without doc_id is given with its fingerprint; it links others, and its
    component_id is the smallest id of its group (null if none has one). Other columns are not read. Bounds
    the session's Arrow batches (``small_batches``).
    """
    small_batches(docs.sparkSession)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "point"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with scratch_scope() as keep:
        rows = keep(docs.mapInArrow(prints, "doc_id long, point long"), "simhash-rows")
        named = keep(_named(rows, limit, stretches), "simhash-named")
    return join_groups(rows, named, "point").select(
        "doc_id", F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _named(rows: DataFrame, limit: int, stretches: int) -> DataFrame:
    """point, copies and component_id of all fingerprints of ``rows`` (stored: doc_id, point)."""
    points = materialize(
        rows.groupBy("point").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least")), "simhash-points"
    )
    found = components(near_pairs(points, limit, stretches)).withColumnRenamed("node", "point")
    rooted = points.join(found, "point", "left").withColumn("component", F.coalesce("component", "point"))
    # a component's root may be a point of any id: its smallest id is counted once, before the rows are joined
    smallest = rooted.groupBy("component").agg(F.count(F.lit(1)).alias("copies"), F.min("least").alias("component_id"))
    smallest = materialize(smallest, "simhash-components")
    pairs = materialize(rooted.select("point", "component"), "simhash-rooted")
    named = join_groups(pairs, smallest, "component").join(points.select("point", "copies"), "point")
    return named.select("point", "copies", "component_id")
