"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, the same on every machine. An n-gram's vector
binds its letters: the vectors are rotated by position and multiplied. A text bundles (adds)
the vectors of all its n-grams, a language the vectors of all its training texts; a text has
the language whose prototype is nearest by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycrest.llm.common import small_batches

DIMENSIONS = 1024
GRAM = 3
SEED = 20240229
#: Languages that a model may hold; more labels than this are a fault of the input.
MOST_LANGUAGES = 4096
#: Characters handled at a time; longer texts go in pieces that overlap by GRAM - 1.
PIECE = 1 << 18
SPACE = 32

_letters: np.ndarray | None = None
_vectors: dict[int, np.ndarray] = {}


def _letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def letter_vector(code: int) -> np.ndarray:
    if code not in _vectors:
        draw = np.random.default_rng((SEED, code)).integers(0, 2, DIMENSIONS)
        _vectors[code] = (2 * draw - 1).astype(np.int8)
    return _vectors[code]


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """One row for each n-gram of code points: rotated letters, multiplied."""
    letters, place = np.unique(codes, return_inverse=True)
    table = np.stack([letter_vector(int(c)) for c in letters])
    place = place.reshape(codes.shape)
    out = np.ones((len(codes), DIMENSIONS), np.int8)
    for i in range(GRAM):
        out *= np.roll(table, GRAM - 1 - i, axis=1)[place[:, i]]
    return out


def _codes(text: str) -> np.ndarray:
    """Lower-case letters with one space around and between words; empty without a letter."""
    data = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[data]
    if not letter.any():
        return np.zeros(0, np.uint32)
    data = np.where(letter, data, SPACE)
    data = np.concatenate([[SPACE], data, [SPACE]]).astype(np.uint32)
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != SPACE) | (data[:-1] != SPACE)
    return data[keep]


def _grams(text: str) -> Iterator[np.ndarray]:
    """N-grams of a text, three code points packed in a number, a bounded piece at a time."""
    codes = _codes(text).astype(np.uint64)
    for start in range(0, len(codes) - GRAM + 1, PIECE):
        piece = codes[start : start + PIECE + GRAM - 1]
        packed = np.zeros(len(piece) - GRAM + 1, np.uint64)
        for i in range(GRAM):
            packed = (packed << np.uint64(21)) | piece[i : len(packed) + i]
        yield packed


def _unpack(packed: np.ndarray) -> np.ndarray:
    shifts = np.array([21 * (GRAM - 1 - i) for i in range(GRAM)], np.uint64)
    return ((packed[:, None] >> shifts) & np.uint64((1 << 21) - 1)).astype(np.int64)


def _bundles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """One bundled vector for each text and its count of n-grams."""
    keys, counts, owner = [], [], []
    total = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        for packed in _grams(text or ""):
            own, n = np.unique(packed, return_counts=True)
            keys.append(own)
            counts.append(n)
            owner.append(np.full(len(own), i))
            total[i] += len(packed)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    if not keys:
        return out, total
    key, count, who = np.concatenate(keys), np.concatenate(counts).astype(np.float32), np.concatenate(owner)
    grams, place = np.unique(key, return_inverse=True)
    order = np.argsort(place, kind="stable")
    place, count, who = place[order], count[order], who[order]
    step = 2048  # n-grams at a time: bounds the two matrices
    for start in range(0, len(grams), step):
        low, high = np.searchsorted(place, [start, start + step])
        incidence = np.zeros((len(texts), min(step, len(grams) - start)), np.float32)
        np.add.at(incidence, (who[low:high], place[low:high] - start), count[low:high])
        out += incidence @ gram_vectors(_unpack(grams[start : start + step])).astype(np.float32)
    return out, total


GROUP = 128  # texts bundled in one product


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, list[float]]:
    """A prototype for each non-null language of ``docs``: the bundle of all its texts.

    Partitions send one vector for each language and batch, which are added up by language
    and dimension; the result, at most ``MOST_LANGUAGES`` vectors, is all that reaches the driver.
    """
    small_batches(docs.sparkSession)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for name in sorted(set(langs)):
                grams: dict[int, int] = {}
                parts = [p for i in np.flatnonzero(langs == name) for p in _grams(texts[i] or "")]
                if not parts:
                    continue
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                total = sums.setdefault(name, np.zeros(DIMENSIONS, np.float64))
                for start in range(0, len(keys), 4096):
                    block = gram_vectors(_unpack(keys[start : start + 4096])).astype(np.float32)
                    total += counts[start : start + 4096].astype(np.float32) @ block
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            ["lang", "v"],
        )

    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    summed = (
        rows.mapInArrow(bundle, "lang string, v array<double>")
        .select("lang", F.posexplode("v").alias("d", "x"))
        .groupBy("lang", "d")
        .agg(F.sum("x").alias("x"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("d", "x"))).alias("v"))
        .limit(MOST_LANGUAGES + 1)
        .collect()
    )
    if len(summed) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {r["lang"]: [p["x"] for p in r["v"]] for r in sorted(summed, key=lambda r: r["lang"])}


def identify(docs: DataFrame, model: dict[str, list[float]], text: str = "text") -> DataFrame:
    """``docs`` without its text, plus lang_pred and score (the cosine, not below 0).

    Null texts and texts without a letter, or any text if nothing was learned, are ``und``
    with score 0; ties go to the first language by name. Columns of ``docs`` named like an
    added one are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    kept = [f for f in docs.schema if f.name != text]
    names = [f.name for f in kept]
    langs = sorted(model)
    prototypes = np.array([model[x] for x in langs], np.float64).reshape(len(langs), DIMENSIONS)
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)
    prototypes = prototypes.astype(np.float32)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            found: list[str] = []
            scores: list[float] = []
            for start in range(0, len(texts), GROUP):
                bundles, counts = _bundles(texts[start : start + GROUP])
                if not langs:
                    found += ["und"] * len(counts)
                    scores += [0.0] * len(counts)
                    continue
                norm = np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-12)
                cosine = (bundles / norm) @ prototypes.T
                best = cosine.argmax(axis=1)
                for i, n in enumerate(counts):
                    found.append(langs[best[i]] if n else "und")
                    scores.append(float(min(1.0, max(0.0, cosine[i, best[i]]))) if n else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(x) for x in names], pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                [*names, "lang_pred", "score"],
            )

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.mapInArrow(name, f"{fields}lang_pred string, score double")
