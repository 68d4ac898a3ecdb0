"""Ranked lexical search in K2-treaps over a grid of terms by documents.

The documents of a task are taken in shards of bounded size. A shard's grid has a row for each term of the
items, heavier terms first, and a column for each document, smaller ids first; a cell holds the term's
impact, the part it adds to the document's score. The grid is stored as a K2-treap: a quadtree of which only
quadrants with postings exist, each with the greatest impact in it. Levels are plain arrays; the place
of a quadrant on its level is the rank of its bit on the level above.

An item descends the row paths of all its terms together. A range of documents is bounded by the sum of
the maxima of the quadrants where the paths cross it; ranges are taken best first, a bounded number at a time, and split in
two, until no range left can reach the worst of the best documents found. At single documents the maxima are the
impacts themselves, so their sum is the score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycrest.llm.common import small_batches
from tallycrest.session import materialize

#: Documents and postings of a shard.
SHARD_DOCS = 1 << 14
SHARD_POSTINGS = 4_000_000
#: Parts of an item's rows that are merged first.
MERGE_SLICES = 64
#: Ranges that are split at once.
AT_ONCE = 256

#: Bytes that part words become spaces; A-Z become lower case; from 0x80 on all belong to words.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> Counter:
    """Occurrences of each term of a whole text."""
    return Counter((text or "").encode("utf-8", "surrogatepass").translate(WORDS).split())


class Treap:
    """Quadtree maxima of a grid with 2**levels rows and columns."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray):
        top = max(int(row.max(initial=0)), int(column.max(initial=0)))
        self.levels = max(1, top.bit_length())
        code = _interleaved(row, column)
        by = np.argsort(code, kind="stable")
        code, value = code[by], value[by]
        self.maxima: list[np.ndarray] = []  # by level from the root; the last has single cells
        self.ranks: list[np.ndarray] = []  # of level i: place on level i + 1 of each quadrant of a cell, -1 if empty
        for level in range(self.levels, -1, -1):
            if level < self.levels:
                parent = code >> 2
                opens = np.diff(parent, prepend=-1) > 0
                ranks = np.full(4 * int(opens.sum()), -1, np.int32)
                ranks[4 * (np.cumsum(opens) - 1) + (code & 3)] = np.arange(len(code))
                self.ranks.append(ranks)
                code = parent[opens]
                value = np.maximum.reduceat(value, np.flatnonzero(opens)) if len(code) else value[:0]
            self.maxima.append(value)
        self.maxima.reverse()
        self.ranks.reverse()

    def best(self, rows: np.ndarray, count: int, least: int) -> list[tuple[int, int]]:
        """The ``count`` columns of the highest sums over ``rows`` (ties: smaller columns first), as
        (sum, column), of those above ``least``."""
        found: list[tuple[int, int]] = []
        if not len(self.maxima[0]) or not len(rows):
            return found
        # the waiting ranges: level, first column, bound, and the quadrant of each row's path (-1: empty)
        level = np.zeros(1, np.int64)
        first = np.zeros(1, np.int64)
        bound = self.maxima[0][:1] * len(rows)
        cells = np.zeros((1, len(rows)), np.int32)
        while len(level):
            if len(found) == count:
                least, last = found[-1]
                keep = (bound > least) | ((bound == least) & (first < last))
            else:
                keep = bound > least
            if not keep.all():
                level, first, bound, cells = level[keep], first[keep], bound[keep], cells[keep]
                if not len(level):
                    break
            now = np.arange(len(level))
            if len(level) > AT_ONCE:
                now = np.argpartition(-bound, AT_ONCE)[:AT_ONCE]
            done = now[level[now] == self.levels]
            if len(done):
                found += zip(bound[done].tolist(), first[done].tolist(), strict=True)
                found = sorted(found, key=lambda x: (-x[0], x[1]))[:count]
            split = now[level[now] < self.levels]
            parts = [self._halves(level[split], first[split], cells[split], rows)] if len(split) else []
            rest = np.ones(len(level), bool)
            rest[now] = False
            parts.append((level[rest], first[rest], bound[rest], cells[rest]))
            level, first, bound, cells = (np.concatenate(x) for x in zip(*parts, strict=True))
        return found

    def _halves(self, level, first, cells, rows):
        """Both halves of ranges of columns, with their bounds and row paths."""
        out_bound = np.zeros((2, len(level)), np.int64)
        out_cells = np.full((2, *cells.shape), -1, np.int32)
        for at in np.unique(level):
            which = np.flatnonzero(level == at)
            row_bit = (rows >> (self.levels - 1 - at)) & 1
            here = cells[which]
            for half in (0, 1):
                child = np.where(here >= 0, self.ranks[at][4 * np.maximum(here, 0) + 2 * row_bit + half], -1)
                out_cells[half, which] = child
                out_bound[half, which] = np.where(child >= 0, self.maxima[at + 1][np.maximum(child, 0)], 0).sum(axis=1)
        width = 1 << (self.levels - 1 - level)
        return (
            np.concatenate([level + 1, level + 1]),
            np.concatenate([first, first + width]),
            out_bound.ravel(),
            out_cells.reshape(-1, cells.shape[1]),
        )


def _interleaved(row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Bits of row and column in turn, the row's first."""
    code = np.zeros(len(row), np.int64)
    for i in range(31):
        code |= ((row >> i) & 1) << (2 * i + 1) | ((column >> i) & 1) << (2 * i)
    return code


@dataclass
class Statistics:
    """What scores need: documents with a term, their terms in all, and for each term of the items its weight."""

    documents: int
    occurrences: int
    weights: np.ndarray

    def length_factor(self, n: list[int]) -> np.ndarray:
        """m of documents of ``n`` terms (Python's integers: the product may pass 64 bits)."""
        return np.array([10 + 90 * x * self.documents // self.occurrences for x in n], np.int64)

    def impacts(self, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def item_terms(items: DataFrame) -> tuple[list[bytes], dict[int, np.ndarray]]:
    """The terms of all items, and of each item the places of its terms there. The items are the stated
    queries: they and their terms are held by the driver and every worker."""
    own: dict[int, set[bytes]] = {}
    for row in items.filter("item_id IS NOT NULL").select("item_id", "text").toLocalIterator():
        own.setdefault(row["item_id"], set()).update(terms(row["text"]))
    names = sorted(set().union(*own.values()))
    place = {t: i for i, t in enumerate(names)}
    return names, {i: np.array(sorted(map(place.__getitem__, t)), np.int64) for i, t in own.items()}


def postings(docs: DataFrame, names: list[bytes]) -> DataFrame:
    """doc_id, n (all terms of the text) and its terms among ``names``, with their occurrences."""
    place = {t: i for i, t in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends, which, often = [], [0], [], []
            for text in batch.column("text").to_pylist():
                counted = terms(text)
                n.append(counted.total())
                for t in counted.keys() & place.keys():
                    which.append(place[t])
                    often.append(counted[t])
                ends.append(len(which))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(which, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(often, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tf"],
            )

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, tf array<long>")


def statistics(stored: DataFrame, names: list[bytes]) -> Statistics:
    """Counts over all documents; one row for each term of the items comes to the driver."""
    total = stored.agg(F.count(F.when(F.col("n") > 0, 1)).alias("d"), F.coalesce(F.sum("n"), F.lit(0)).alias("o")).first()
    df = np.zeros(len(names), np.int64)
    for row in stored.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[row["t"]] = row["count"]
    weights = [math.floor(1000 * math.log((2 * total["d"] + 2) / (2 * x + 1))) for x in df.tolist()]
    return Statistics(total["d"], total["o"], np.array(weights, np.int64))


def search(docs: DataFrame, items: DataFrame, count: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``count`` documents of highest score above 0.

    ``docs``: doc_id, text; ``items``: item_id, text, the stated query set, which is held by the driver and the
    workers. Scores are integers (BM25 in steps, see ``Statistics``); equal scores go by smaller doc_id. Terms are
    runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased, counted over
    whole texts. Each task keeps the best of the shards before, which bound the next; only ``count`` rows of an
    item leave a task, to be merged.

    Null texts and texts without terms match nothing and count for nothing; rows without a doc_id, too. Repeated
    rows are documents of their own, each with its rank. Rows of one item_id make one item; items without an id or
    terms, and empty tables, give no rows. Other columns are not read. Bounds the session's Arrow batches
    (``small_batches``).
    """
    small_batches(docs.sparkSession)
    names, own = item_terms(items)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    stored = materialize(postings(docs, names), "treap-postings")
    known = statistics(stored, names)
    heavy_first = np.argsort(-known.weights, kind="stable")
    row_of = np.empty(len(names), np.int64)
    row_of[heavy_first] = np.arange(len(names))
    paths = {i: row_of[t] for i, t in own.items()}
    id_type = dict(items.dtypes)["item_id"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {i: [] for i in paths}

        def shard(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held).sort_by("doc_id").combine_chunks()
            ids, n = rows["doc_id"].to_numpy(), rows["n"].to_pylist()
            lists = rows["terms"].combine_chunks()
            term, tf = lists.flatten().to_numpy(), rows["tf"].combine_chunks().flatten().to_numpy()
            column = np.repeat(np.arange(len(ids)), np.diff(np.asarray(lists.offsets)))
            values = known.impacts(term, tf, known.length_factor(n)[column])
            some = values > 0
            treap = Treap(row_of[term[some]], column[some], values[some])
            for item, path in paths.items():
                # a later shard may hold smaller ids: equal scores are found, too
                full = len(best[item]) == count
                new = treap.best(path, count, best[item][-1][0] - 1 if full else 0)
                if new:
                    merged = best[item] + [(score, int(ids[c])) for score, c in new]
                    best[item] = sorted(merged, key=lambda x: (-x[0], x[1]))[:count]

        held, docs_held, postings_held = [], 0, 0
        for batch in batches:
            held.append(batch)
            docs_held += len(batch)
            postings_held += len(batch.column("terms").flatten())
            if docs_held >= SHARD_DOCS or postings_held >= SHARD_POSTINGS:
                shard(held)
                held, docs_held, postings_held = [], 0, 0
        if docs_held:
            shard(held)
        rows = [(i, d, s) for i, found in best.items() for s, d in found]
        yield pa.RecordBatch.from_pydict(
            {"item_id": [x[0] for x in rows], "doc_id": [x[1] for x in rows], "score": [x[2] for x in rows]},
            schema=pa.schema([("item_id", item_arrow), ("doc_id", pa.int64()), ("score", pa.int64())]),
        )

    from pyspark.sql.pandas.types import to_arrow_type

    item_arrow = to_arrow_type(items.schema["item_id"].dataType)
    found = stored.filter("size(terms) > 0").mapInArrow(look, f"item_id {id_type}, doc_id long, score long")
    # in two steps, so that no task takes the rows of all others for an item
    found = found.withColumn("slice", F.expr(f"pmod(xxhash64(doc_id), {MERGE_SLICES})"))
    best, by = ("item_id", "slice"), (F.desc("score"), F.col("doc_id"))
    for keys in (best, best[:1]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
        found = found.filter(F.col("rank") <= count)
    return found.select("item_id", "rank", "doc_id", "score")
