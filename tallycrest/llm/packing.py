"""Harmonic packing of tokenised documents into sequences of a fixed length.

A piece of length r belongs to the class j = capacity // r: j such pieces fit a sequence, and
a class fills every sequence with exactly j of its pieces, so sequences need only a count and
classes need nothing of each other. Documents may be cut, so a length far from its class's
largest is cut down to about the largest of the next class, capacity // (j + 1); what remains
is handled alike and shrinks fast. Every full sequence then wastes at most ``SLACK`` tokens.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycrest.llm.common import small_batches
from tallycrest.session import materialize

CAPACITY = 2048
SLACK = 32
END = 1
#: Words whose ids a Python worker remembers.
REMEMBERED = 400_000

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of whole texts under a byte-level BPE of the ``tokenizers`` library.

    The pre-tokenizer never joins what stands left and right of a single space between two
    other characters, and merges stay inside its pieces. So such words are encoded once, by
    ``tiktoken`` with the same vocabulary as ranks, and remembered; a text in which an added
    token's string occurs goes whole through ``tokenizers``.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_file)
        added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
        self.known: dict[str, bytes] = {}
        self.spaces = re.compile(r"\s\s")
        self.single = re.compile(r"(?<=\S) (?=\S)")

    def _split(self, text: str) -> list[str]:
        """Pieces; all but the first follow a space that stands alone."""
        return self.single.split(text) if self.spaces.search(text) else text.split(" ")

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        split: list[list[str] | None] = []
        new: dict[str, None] = {}
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for text in texts:
            if self.special is not None and self.special.search(text):
                split.append(None)
                continue
            words = self._split(text)
            split.append(words)
            new.update(dict.fromkeys(w for w in words[1:] if w not in self.known))
        self._learn(list(new))
        out = []
        for text, words in zip(texts, split, strict=True):
            if words is None:
                ids = self.whole.encode(text, add_special_tokens=False).ids
                out.append(np.array(ids, np.uint32))
                continue
            first = np.array(self.words.encode_ordinary(words[0]), "<u2").tobytes()
            joined = first + b"".join(map(self.known.__getitem__, words[1:]))
            out.append(np.frombuffer(joined, "<u2").astype(np.uint32))
        return out

    def _learn(self, words: list[str]) -> None:
        """Encode new words, many in one call: their borders are found by the tokens' bytes."""
        ordinary = [w for w in words if w and not w[0].isspace() and not w[-1].isspace()]
        for word in set(words).difference(ordinary):
            self.known[word] = np.array(self.words.encode_ordinary(" " + word), "<u2").tobytes()
        for start in range(0, len(ordinary), 5000):
            some = ordinary[start : start + 5000]
            ids = np.array(self.words.encode_ordinary(" " + " ".join(some)), "<u2")
            ends = np.cumsum(self.width[ids])
            borders = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in some])
            cuts = np.searchsorted(ends, borders) + 1
            data, last = ids.tobytes(), 0
            for word, cut in zip(some, cuts.tolist(), strict=True):
                self.known[word] = data[2 * last : 2 * cut]
                last = cut


def encoder(tokenizer: str | None = None, ranks: str | None = None) -> Encoder:
    """One in a Python worker; the files come with the ``public_tokenizers`` package of each machine."""
    import public_tokenizers

    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if tokenizer not in _encoders:
        _encoders[tokenizer] = Encoder(tokenizer, ranks, public_tokenizers.PATTERN)
    return _encoders[tokenizer]


def cut_lengths(length: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Pieces of a document: whole sequences, then lengths that fill their class's sequences."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        j = capacity // rest
        if capacity - j * rest <= slack:
            out.append(rest)
            break
        piece = next(n for n in range(capacity // (j + 1), 0, -1) if capacity % n <= slack)
        out.append(piece)
        rest -= piece
    return out


def tokenise(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids, doc_tokens, block, class and rank in block.

    ``block`` names the task that made the piece, ``nth`` counts the block's pieces of a class.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        own = encoder(tokenizer, ranks)
        seen: dict[int, int] = {}
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            who, starts, lengths, totals, classes, nths, parts = [], [], [], [], [], [], []
            for i, ids in enumerate(own.ids([t or "" for t in texts])):
                ids = np.append(ids, np.uint32(END))
                at = 0
                for n in cut_lengths(len(ids)):
                    j = CAPACITY // n
                    seen[j] = seen.get(j, -1) + 1
                    who.append(i)
                    starts.append(at)
                    lengths.append(n)
                    totals.append(len(ids))
                    classes.append(j)
                    nths.append(seen[j])
                    at += n
                parts.append(ids)
            flat = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids.take(pa.array(who, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array([block] * len(who), pa.int32()),
                    pa.array(classes, pa.int32()),
                    pa.array(nths, pa.int64()),
                ],
                ["doc_id", "start", "length", "doc_tokens", "ids", "block", "class", "nth"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut,
        f"doc_id {kind}, start long, length long, doc_tokens long, ids array<int>, block int, class int, nth long",
    )


def pack(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pieces with their sequence: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Pieces are numbered inside their class: a block's own count plus the sum of the counts of
    the blocks before it. That number, divided by the class's fixed count, is the sequence.
    Only counts by block and class are shuffled, no ids, and a class that holds a third of
    all pieces costs no more than any other. The rest of each class, at most one sequence,
    shares sequences with the rests of other classes. Positions inside a sequence come from its pieces'
    lengths, which need a shuffle of three numbers a piece.

    Null text counts as empty: a document of the closing id alone. Repeated rows are packed
    each; an empty table gives no rows; other columns are not read.
    """
    pieces = materialize(tokenise(docs, tokenizer, ranks), "packing-pieces")
    counts = pieces.groupBy("class", "block").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("class").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("class", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # the full sequences of class j are numbered after those of smaller classes
    smaller = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    full = (
        counts.groupBy("class")
        .agg(F.sum("n").alias("n"))
        .withColumn("full", F.expr("n DIV class"))
        .withColumn("first", F.coalesce(F.sum("full").over(smaller), F.lit(0)))
    )
    numbered = (
        pieces.join(bases, ["class", "block"])
        .join(F.broadcast(full.drop("n")), "class")  # at most CAPACITY classes
        .withColumn("number", F.col("base") + F.col("nth"))
    )
    # what is left of each class, under one sequence, shares sequences with other classes' rests
    rest = F.col("number") >= F.col("full") * F.col("class")
    rests = numbered.filter(rest).groupBy("class").agg(F.sum("length").alias("length")).collect()
    shared = _share(sorted(((r["length"], r["class"]) for r in rests), reverse=True))
    spark = pieces.sparkSession
    homes = spark.createDataFrame(shared, "class int, home long, turn long")
    total = full.agg(F.coalesce(F.sum("full"), F.lit(0)).alias("total"))
    return (
        numbered.join(F.broadcast(homes), "class", "left")
        .join(F.broadcast(total))  # one row
        .withColumn("sequence_id", F.when(rest, F.expr("total + home")).otherwise(F.expr("first + number DIV class")))
        .withColumn("place", F.expr("number % class") + F.when(rest, F.col("turn") * CAPACITY).otherwise(0))
        .drop("base", "full", "first", "number", "home", "turn", "total")
    )


def _share(rests: list[tuple[int, int]], capacity: int = CAPACITY) -> list[tuple[int, int, int]]:
    """First fit, largest first, of at most ``capacity`` rests: class, shared sequence, turn in it."""
    free: list[list[int]] = []  # room, rests so far
    out = []
    for length, name in rests:
        at = next((i for i, (room, _) in enumerate(free) if room >= length), len(free))
        if at == len(free):
            free.append([capacity, 0])
        out.append((name, at, free[at][1]))
        free[at][0] -= length
        free[at][1] += 1
    return out


def offsets(numbered: DataFrame) -> DataFrame:
    """``numbered`` with the offset of each piece in its sequence (at most CAPACITY pieces)."""
    inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))


def with_checksums(pieces: DataFrame) -> DataFrame:
    """``ids_crc32`` instead of ``ids``: the checksum of little-endian 32-bit ids."""
    small_batches(pieces.sparkSession)
    kept = [f for f in pieces.schema if f.name != "ids"]
    names = [f.name for f in kept]

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            cuts = (np.asarray(lists.offsets) * 4).tolist()
            sums = [zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sums, pa.int64())], [*names, "ids_crc32"]
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return pieces.mapInArrow(checksum, f"{fields}, ids_crc32 long")
