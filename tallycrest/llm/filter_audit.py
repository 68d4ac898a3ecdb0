"""How document filters interact: what each removes at each step of every order.

The filters' outcomes make a contingency table: per part, the documents in each of the 2 x 2 x ... x 2
cells of pass and fail. Spark counts the cells, once for all documents and once for each mark (good,
toxic). Everything else is a contraction of that tensor: a step of an order selects *pass* along the axes
of the filters before it, *fail* along its own and *all* along those after it, so one ``einsum`` gives all
steps of all orders.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycrest.session import materialize

SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

ROWS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def conditions(text: Column) -> dict[str, Column]:
    """Failure of A (under 100 words), B (under 80 % distinct words), C (over 10 % of A-Z), D (a sign of #$%&*|)."""
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def steps(filters: str) -> tuple[list[tuple[str, int]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, step) of all orders; the axis selectors (step, filter, 2) of what the step keeps, what it
    removes, what fails its filter at all, and what fails its filter alone."""
    names, kept, removed, failing, alone = [], [], [], [], []
    for order in permutations(filters):
        for i, own in enumerate(order):
            before = set(order[:i])
            names.append(("".join(order), i + 1))
            kept.append([PASS if f in before or f == own else ALL for f in filters])
            removed.append([PASS if f in before else FAIL if f == own else ALL for f in filters])
            failing.append([FAIL if f == own else ALL for f in filters])
            alone.append([FAIL if f == own else PASS for f in filters])
    return names, *(np.array(x, np.int64) for x in (kept, removed, failing, alone))


def contracted(cells: np.ndarray, selectors: np.ndarray) -> np.ndarray:
    """Counts (mark, step) of a tensor (mark, 2, 2, ...) under axis selectors (step, filter, 2)."""
    axes = "abcdefghijklmnop"[: cells.ndim - 1]
    return np.einsum(f"w{axes},{','.join('s' + x for x in axes)}->ws", cells, *np.moveaxis(selectors, 1, 0))


def report(part: str, cells: np.ndarray, filters: str) -> pd.DataFrame:
    """All steps of all orders of one part. ``cells``: (all, good, toxic) by pass (0) and fail (1) of each filter."""
    names, kept, removed, failing, alone = steps(filters)
    gone, good, toxic = contracted(cells, removed)
    own = np.array([order[step - 1] for order, step in names])
    total = {f: int(gone[own == f].sum()) for f in filters}
    return pd.DataFrame(
        {
            "part": part,
            "filter_order": [order for order, _ in names],
            "step": np.array([step for _, step in names], np.int32),
            "kept": contracted(cells[:1], kept)[0],
            "removed": gone,
            "redundant": contracted(cells[:1], failing)[0] - gone,
            "unique_fails": contracted(cells[:1], alone)[0],
            "good_lost": good,
            "toxic_lost": toxic,
            "shapley": [total[f] for f in own],
        }
    )


def cell_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, flags (bits of the failed text conditions), and of the documents that pass / fail the repeat
    filter: all, good and toxic ones.

    Equal texts are equal by SHA-256. Rows are reduced before every shuffle, and only ids, digests and flags
    are shuffled: first by all columns, so that repeated rows become one, then by id to their labels, then
    by digest, where all copies of a text in a partition are one row already.
    """
    text = F.coalesce("text", F.lit(""))
    flags = sum(F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(conditions(text).values()))
    one = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            flags.alias("flags"),
        )
        .groupBy("doc_id", "part", "digest", "flags")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    one = materialize(one, "audit-documents")  # the texts are read once
    marks = (
        labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    no = F.lit(False)
    marked = (
        one.filter("doc_id IS NOT NULL")
        .join(marks, "doc_id", "left")
        .withColumns({m: F.coalesce(m, no) for m in ("good", "toxic")})
        .unionByName(one.filter("doc_id IS NULL").withColumns({"good": no, "toxic": no}))
    )
    kinds = marked.groupBy("digest", "part", "flags", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        # rows without an id repeat nothing; of the others those of the smallest id pass
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"),
        F.coalesce(F.min_by(F.when(F.col("doc_id").isNotNull(), F.col("n")), "doc_id"), F.lit(0)).alias("at_first"),
    )
    kinds = materialize(kinds, "audit-kinds")
    firsts = kinds.groupBy("digest").agg(F.min("first").alias("smallest"))
    judged = (
        kinds.join(firsts, "digest")
        .withColumn("passed", F.col("no_id") + F.when(F.col("first") == F.col("smallest"), F.col("at_first")).otherwise(0))
        .withColumn("failed", F.col("n") - F.col("passed"))
    )
    return judged.groupBy("part", "flags").agg(
        *[
            F.sum(F.when(which, F.col(side)).otherwise(0)).alias(f"{name}_{side}")
            for name, which in (("all", F.lit(True)), ("good", F.col("good")), ("toxic", F.col("toxic")))
            for side in ("passed", "failed")
        ]
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters A-E and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley.

    ``docs``: doc_id, text, lang (the part; null is the empty string); ``labels``: doc_id, quality, toxic.
    A-D are ``conditions``; E fails where a smaller doc_id has the same text. Null texts are empty, and
    empty texts equal each other. Rows count one by one: rows that repeat a doc_id with its text pass or fail
    E together, rows without a doc_id pass E and have no label. A document is good or toxic if any of its
    label rows says so. Empty ``docs`` give no rows. Other columns are not read.
    """
    text_filters = list(conditions(F.lit("")))
    filters = "".join(text_filters) + "E"

    def by_part(cells: pd.DataFrame) -> pd.DataFrame:
        tensor = np.zeros((3, *[2] * len(filters)), np.int64)
        for row in cells.itertuples(index=False):
            at = tuple(row.flags >> i & 1 for i in range(len(text_filters)))
            for k, name in enumerate(("all", "good", "toxic")):
                tensor[(k, *at)] += [getattr(row, f"{name}_passed"), getattr(row, f"{name}_failed")]
        return report(cells["part"].iloc[0], tensor, filters)

    return cell_counts(docs, labels).groupBy("part").applyInPandas(by_part, ROWS)
