"""Toxicity by compression distance with two zstandard dictionaries.

The ordinary dictionary is trained on ordinary text; the toxic one has the same content and,
nearest to the window, the words that mark toxic text. A window of a few words compresses
shorter with the toxic dictionary only by what it shares with those words, and common text
cancels out. How many windows gain how much is calibrated on labelled text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycrest.llm.common import small_batches

#: Labelled documents that train a model, about: toxic, ordinary. Each is read whole.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 3000, 6000
#: Words of a window, compression level, bytes of the common content and of the toxic passages.
WINDOW, LEVEL, COMMON_BYTES, TOXIC_BYTES = 4, 3, 65536, 16384
#: A word marks toxic text if it stands after so many different words, and so many times as
#: often (by contexts) as in ordinary text. Contexts, because copies of a text repeat one context.
CONTEXTS, RATIO = 8, 8.0
#: Gains in bytes that are counted.
GAINS = (3, 4, 5, 7)
#: Windows compressed in one call.
CALL = 100_000
THRESHOLD = 0.3

SPACES = bytes(32 if b in (9, 10, 11, 12, 13, 28, 29, 30, 31) else b for b in range(256))


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    centre: list[float]
    weights: list[float]
    bias: float
    cut: float  # probability that becomes the score THRESHOLD


def line_of(text: str | None) -> bytes:
    return b" " + (text or "").lower().encode("utf-8", "surrogatepass").translate(SPACES) + b" "


def windows(line: bytes) -> np.ndarray:
    """(start, length) of windows of whole words, with the spaces around them."""
    data = np.frombuffer(line, np.uint8)
    space = data == 32
    starts = np.flatnonzero(space[:-1] & ~space[1:])  # the space before each word
    first = starts[::WINDOW]
    if not len(first):
        return np.zeros((0, 2), np.uint64)
    ends = np.append(first[1:] + 1, len(line))
    return np.stack([first, ends - first], axis=1).astype(np.uint64)


class Scorer:
    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = self._compressor(ordinary), self._compressor(toxic)

    @staticmethod
    def _compressor(content: bytes):
        import zstandard

        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def gains(self, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that each window gains from the toxic passages, and where each line's windows begin."""
        import zstandard

        parts, counts, at = [], [], 0
        for line in lines:
            w = windows(line)
            counts.append(len(w))
            w[:, 0] += np.uint64(at)
            parts.append(w)
            at += len(line)
        data = b"".join(lines)
        segments = np.concatenate(parts) if parts else np.zeros((0, 2), np.uint64)
        out = []
        for start in range(0, len(segments), CALL):
            given = zstandard.BufferWithSegments(data, segments[start : start + CALL].astype("<u8").tobytes())
            sizes = []
            for compressor in (self.ordinary, self.toxic):
                packed = compressor.multi_compress_to_buffer(given)
                sizes.append(np.fromiter(map(len, packed), np.int64, len(packed)))
            out.append(sizes[0] - sizes[1])
        return (np.concatenate(out) if out else np.zeros(0, np.int64)), np.concatenate([[0], np.cumsum(counts)])

    def features(self, lines: list[bytes]) -> np.ndarray:
        """Per text: counts and shares of windows by gain, the largest gain, the number of windows."""
        gain, at = self.gains(lines)
        n = np.diff(at)
        size = np.maximum(n, 1)
        out = []
        for least in GAINS:
            hits = np.concatenate([[0], np.cumsum(gain >= least)])
            count = hits[at[1:]] - hits[at[:-1]]
            out += [np.log1p(count), np.sqrt(count / size)]
        largest = np.array([gain[a:b].max(initial=0) for a, b in zip(at, at[1:], strict=False)])
        out += [np.clip(largest, 0, 30), np.log1p(n)]
        return np.stack(out, axis=1).astype(np.float64)


def _hashed(text: str) -> tuple[list[bytes], np.ndarray]:
    import xxhash

    words = line_of(text).split()
    return words, np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _contexts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, ascending, and the number of different words before each."""
    seen = [np.zeros((0, 2), np.uint64)]
    for text in texts:
        own = _hashed(text)[1]
        seen.append(np.unique(np.stack([own, np.r_[np.uint64(0), own[:-1]]], axis=1), axis=0) if len(own) else seen[0])
    pairs = np.concatenate(seen)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    new = (np.diff(pairs, axis=0, prepend=pairs[:1] + np.uint64(1)) != 0).any(axis=1)
    return np.unique(pairs[new, 0], return_counts=True)


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; of too few samples to train one, the samples themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _passages(toxic: list[str], ordinary: list[str]) -> bytes:
    """Words that mark toxic text; those of most contexts stand last, where matches are cheapest."""
    (marked, often), (plain, there) = _contexts(toxic), _contexts(ordinary)
    share = often / max(1, often.sum())
    at = np.minimum(np.searchsorted(plain, marked), max(0, len(plain) - 1))
    usual = np.where(plain[at] == marked, there[at], 0) if len(plain) else np.zeros(len(marked), np.int64)
    chosen = (often >= CONTEXTS) & (share / ((usual + 1) / max(1, there.sum())) >= RATIO)
    wanted = dict(zip(marked[chosen].tolist(), often[chosen].tolist(), strict=True))
    found = set()
    for text in toxic:  # hashes to words
        words, hashes = _hashed(text)
        found |= {(wanted[h], w) for w, h in zip(words, hashes.tolist(), strict=True) if h in wanted}
    return b"".join(b" " + word + b" " for _, word in sorted(found))[-TOXIC_BYTES:]


def fit(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """A model from sampled texts; ``share`` is the share of toxic rows among all labelled ones."""
    half = max(1, len(ordinary) // 2)
    samples = []
    for text in ordinary[:half]:
        line = line_of(text)
        samples += [line[int(a) : int(a + n)] for a, n in windows(line)]
    common = _trained(samples, COMMON_BYTES)
    rest = ordinary[half:] or ordinary
    # calibrated on texts that gave no passages: each half is scored with the other half's
    xs, ys = [], []
    for turn in (0, 1):
        own = common + _passages(toxic[1 - turn :: 2] or toxic, ordinary[:half] + rest[1 - turn :: 2])
        scorer = Scorer(common, own)
        for texts, y in ((toxic[turn::2], 1.0), (rest[turn::2], 0.0)):
            if texts:
                for start in range(0, len(texts), 200):
                    xs.append(scorer.features(list(map(line_of, texts[start : start + 200]))))
                ys.append(np.full(len(texts), y))
    x, y = np.concatenate(xs), np.concatenate(ys)
    weight = np.where(y == 1, share / len(toxic), (1 - share) / len(rest)) * len(y)
    centre = np.stack([x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)])
    w = _logistic((x - centre[0]) / centre[1], y, weight)
    p = _probability((x - centre[0]) / centre[1], w)
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(weight[order] * y[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (weight * y).sum())
    best = int(f1.argmax())
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    cut = float(np.clip((p[order][best] + below) / 2, 1e-3, 1 - 1e-3))
    return Model(common, common + _passages(toxic, ordinary), centre.ravel().tolist(), w[1:].tolist(), float(w[0]), cut)


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[1:] + w[0], -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    ridge = np.eye(a.shape[1])
    ridge[0, 0] = 1e-6
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = _probability(x, w)
        slope = a.T @ (weight * (p - y)) + ridge @ w
        curve = (a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + ridge
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _draw(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)).cast("double") / (1 << 30)


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from about ``TOXIC_SAMPLE`` and ``ORDINARY_SAMPLE`` whole labelled texts chosen by hash.

    None if either kind has no text. Labels are counted over all rows. The sample, whose size does not
    depend on the corpus, is fitted in one task; only the model reaches the driver.
    """
    small_batches(docs.sparkSession)
    labels = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", "toxic")
    n = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    chosen = labels.filter(
        F.when(F.col("toxic") == 1, _draw(F.col("doc_id")) < TOXIC_SAMPLE / n[1]).otherwise(
            _draw(F.col("doc_id")) < ORDINARY_SAMPLE / n[0]
        )
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = n[1] / (n[0] + n[1])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted({(t, y) for b in batches for t, y in zip(*(b.column(c).to_pylist() for c in ("text", "toxic")))})
        rng = np.random.default_rng(1)
        rows = [rows[i] for i in rng.permutation(len(rows))]
        toxic, ordinary = [t for t, y in rows if y == 1], [t for t, y in rows if y == 0]
        if toxic and ordinary:
            model = fit(toxic, ordinary, share)
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in model._asdict().items()})

    # bounded by the sample sizes
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = texts.select("text", "toxic").distinct().repartition(1).mapInArrow(
        fitted, "ordinary binary, toxic binary, centre array<double>, weights array<double>, bias double, cut double"
    ).first()
    if found is None:
        return None
    return Model(bytes(found["ordinary"]), bytes(found["toxic"]), *(found[c] for c in ("centre", "weights", "bias", "cut")))


_scorers: dict[int, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    key = hash((model.ordinary, model.toxic))
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model.ordinary, model.toxic)
    return _scorers[key]


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1, higher: more likely toxic) and ``predicted`` (score >= 0.3).

    Every window of every text is compressed. Null and empty texts have no windows and get the
    score of a text without any gain; without a model every score is 0. Repeated rows are scored each;
    columns of ``docs`` that clash with an added one are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    names = docs.columns
    if model is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    # a reference that Spark ships once to each executor
    given = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*given.value)
        scorer = _scorer(model)
        centre = np.array(model.centre).reshape(2, -1)
        w = np.r_[model.bias, model.weights]
        for batch in batches:
            lines = list(map(line_of, batch.column("text").to_pylist()))
            if lines:
                p = _probability((scorer.features(lines) - centre[0]) / centre[1], w)
            else:
                p = np.zeros(0)
            s = np.where(
                p < model.cut,
                THRESHOLD * p / model.cut,
                THRESHOLD + (1 - THRESHOLD) * (p - model.cut) / (1 - model.cut),
            )
            s = np.round(np.clip(s, 0, 1), 9)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                [*names, "score", "predicted"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(judge, f"{fields}, score double, predicted int")
