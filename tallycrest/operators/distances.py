"""Principal components of the distances between wrong and correct predictions, without the matrix.

The matrix has a row for each wrong prediction and a column for each correct one. Subspace iteration
needs only its products with thin matrices: a task computes the distances of a block of wrong
and a block of correct vectors, multiplies them by the block's few columns, and forgets them. Equal vectors
are one row or column that counts as often as it occurs. What reaches the driver are matrices of the
thin width squared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycrest.operators.neighbours import BLOCK_ROWS, CHUNK, join_on_vector, squared_distances, stacked
from tallycrest.session import materialize

#: Further columns of the thin matrices, for faster convergence; largest number of steps.
EXTRA, MAX_STEPS = 6, 60


def _blocks(rows: DataFrame, own: int, other: int, own_name: str, other_name: str, columns: Sequence[str]) -> DataFrame:
    """Each row in its block, once for every block of the other side."""
    return rows.select(
        *columns,
        F.pmod(F.xxhash64("point"), F.lit(own)).cast("int").alias(own_name),
        F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(other_name),
    )


def _multiplied(to: DataFrame, given: DataFrame, to_blocks: int, given_blocks: int, names: list[str]) -> DataFrame:
    """For each point of ``to``: the sums over ``given`` of distance x root weights x thin columns (``names``)."""
    kind = to.schema["point"].dataType.simpleString()
    left = _blocks(to, to_blocks, given_blocks, "tblock", "gblock", ["point", "features", "weight"])
    renamed = given.select("point", F.col("features").alias("vector"), F.col("weight").alias("times"), *names)
    right = _blocks(renamed, given_blocks, to_blocks, "gblock", "tblock", ["vector", "times", *names])

    def tile(t: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(t) and len(g):
            thin = g[names].to_numpy("float64") * np.sqrt(g["times"].to_numpy("float64"))[:, None]
            vectors = stacked(g["vector"])
            for start in range(0, len(t), CHUNK):
                part = t.iloc[start : start + CHUNK]
                product = np.sqrt(squared_distances(stacked(part["features"]), vectors)) @ thin
                product *= np.sqrt(part["weight"].to_numpy("float64"))[:, None]
                parts.append(pd.DataFrame(product, columns=names).assign(point=part["point"].to_numpy()))
        if parts:
            return pd.concat(parts)[["point", *names]]
        return t[["point"]].iloc[:0].assign(**{n: pd.Series(dtype="float64") for n in names})

    sums = (
        left.groupBy("tblock", "gblock").cogroup(right.groupBy("tblock", "gblock"))
        .applyInPandas(tile, f"point {kind}, {', '.join(f'{n} double' for n in names)}")
        .groupBy("point").agg(*[F.sum(n).alias(n) for n in names])
    )
    return to.select("point", "features", "weight").join(sums, "point")


def _gram(rows: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
    """The product of two thin matrices, transposed by plain: parts by batch, added up by cell."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = batch[left].to_numpy("float64").T @ batch[right].to_numpy("float64")
            yield pd.DataFrame({"cell": np.arange(cells.size), "value": cells.ravel()})

    sums = rows.select(*dict.fromkeys([*left, *right])).mapInPandas(part, "cell int, value double")
    found = np.zeros(len(left) * len(right))
    for cell, value in sums.groupBy("cell").agg(F.sum("value")).collect():  # one row for each cell
        found[cell] = value
    return found.reshape(len(left), -1)


def _combined(rows: DataFrame, names: list[str], matrix: np.ndarray, out: list[str]) -> DataFrame:
    """New thin columns ``out``: the columns ``names`` times ``matrix``."""
    kept = ["point", "features", "weight"]

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            product = pd.DataFrame(batch[names].to_numpy("float64") @ matrix, columns=out, index=batch.index)
            yield pd.concat([batch[kept], product], axis=1)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    return rows.select(*kept, *names).mapInPandas(combine, f"{fields}, {', '.join(f'{n} double' for n in out)}")


def _signed(placed: DataFrame, parts: list[str]) -> DataFrame:
    """Each component turned so that its score of largest size is positive (of equal ones, that of the smallest point)."""
    size = placed.agg(*[F.max(F.abs(p)).alias(p) for p in parts]).first()
    largest = {p: F.abs(p) >= F.lit((size[p] or 0.0) * (1 - 1e-9)) for p in parts}
    first = placed.agg(*[F.min_by(p, F.when(largest[p], F.col("point"))).alias(p) for p in parts]).first()
    return placed.withColumns({p: F.col(p) * (-1.0 if (first[p] or 0) < 0 else 1.0) for p in parts})


def distance_components(
    df: DataFrame, key: str, features: str, count: int = 2, block_rows: int = BLOCK_ROWS, tolerance: float = 1e-9
) -> DataFrame:
    """``key`` and pc1, pc2, ... of each wrong prediction: the scores of the centred distance matrix.

    ``df`` has target_encoded, predictions and the vectors ``features``; predictions that equal the target are
    correct. Each component's score of largest size is positive (of equal ones that of the smallest key); components beyond the matrix's rank are 0. Work per
    step is wrong x correct distinct vectors, in blocks of ``block_rows``; iteration ends when the residuals of the wanted
    components are below ``tolerance`` of the largest singular value squared. Without wrong predictions there are no rows.
    """
    right = F.col("target_encoded") == F.col("predictions")
    rows = df.select(F.col(key), F.col(features).alias("features"), right.alias("right"))
    vectors = materialize(
        rows.groupBy("features").agg(
            F.count_if("right").alias("correct"), F.count_if(~F.col("right")).alias("copies"), F.min(key).alias("point")
        ),
        "distance-vectors",
    )
    total, n_wrong, n_right = vectors.agg(
        F.coalesce(F.sum("copies"), F.lit(0)), F.count_if(F.col("copies") > 0), F.count_if(F.col("correct") > 0)
    ).first()
    w_blocks, r_blocks = (max(1, math.ceil(n / block_rows)) for n in (n_wrong, n_right))
    width = max(1, min(count + EXTRA, n_wrong))
    thin = [f"y{i}" for i in range(width)]
    again = [f"x{i}" for i in range(width)]
    root = F.sqrt(F.col("weight").cast("double"))
    wrong = vectors.filter("copies > 0").select("point", "features", F.col("copies").alias("weight"))
    correct = vectors.filter("correct > 0").select("point", "features", F.col("correct").alias("weight"))
    # any start will do; this one does not depend on the order of rows
    start = [((F.pmod(F.xxhash64("point", F.lit(i)), F.lit(2_000_003)) - 1_000_001) / 1e6).alias(n) for i, n in enumerate(thin)]
    side = materialize(wrong.select("*", *start), "distance-thin")
    names, scores = thin, None
    for _ in range(MAX_STEPS):
        # take off the mean of the rows, then make the columns orthonormal
        both = side.withColumn("base", root)
        grams = _gram(both, [*names, "base"], [*names, "base"])
        gram, ones = grams[:-1, :-1], grams[:-1, -1]
        centred = gram - np.outer(ones, ones) / max(total, 1)
        values, basis = np.linalg.eigh(centred)
        keep = values > max(values.max(initial=0.0), 0.0) * 1e-13
        if not keep.any() or not n_right:
            break
        turn = basis[:, keep] / np.sqrt(values[keep])
        thin = thin[: turn.shape[1]]
        again = again[: turn.shape[1]]
        full = np.vstack([turn, -(ones @ turn)[None, :] / total])
        unit = materialize(_combined(both, [*names, "base"], full, thin), "distance-thin")
        across = materialize(_multiplied(correct, unit, r_blocks, w_blocks, thin), "distance-across")
        back = _multiplied(wrong, across, w_blocks, r_blocks, thin).select(
            "point", "features", "weight", *[F.col(a).alias(b) for a, b in zip(thin, again)]
        )
        side = materialize(back.join(unit.select("point", *thin), "point"), "distance-thin")
        both = side.withColumn("base", root)
        grams = _gram(both, [*thin, *again, "base"], [*again, "base"])
        p = len(thin)
        drift = grams[p : 2 * p, p]  # what centring takes off the new columns
        ritz = grams[:p, :p]
        squares = grams[p : 2 * p, :p] - np.outer(drift, drift) / total
        sizes, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        order = np.argsort(-sizes)[:count]
        sizes, turn = sizes[order], turn[:, order]
        residual = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", turn, squares, turn) - sizes**2, 0))
        kept = sizes > max(sizes[0], 0) * 1e-13
        scores = (turn[:, kept] * np.sqrt(np.maximum(sizes[kept], 0)), list(thin))
        if residual[kept].max(initial=0) <= tolerance * max(sizes[0], 1e-300):
            break
        names = again
    parts = [f"pc{i + 1}" for i in range(count)]
    if scores is None:
        placed = wrong.select("features", F.col("weight").alias("copies"), *[F.lit(0.0).alias(p) for p in parts])
    else:
        matrix, names = scores
        missing = np.zeros((len(names), count - matrix.shape[1]))
        turned = _combined(side, names, np.hstack([matrix, missing]), parts)
        placed = turned.select("point", "features", F.col("weight").alias("copies"),
                               *[(F.col(p) / root).alias(p) for p in parts])
        placed = materialize(placed, "distance-scores")
        placed = _signed(placed, parts).drop("point")
    return join_on_vector(rows.filter(~F.col("right")).select(key, "features"), placed, total or 0).select(key, *parts)
