"""From documents to packed sequences: each stage keeps or changes what the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written and read again as the next one's docs. All but the last return the
columns of documents. Null and empty texts pass every filter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycrest.llm import decontaminate, jaccard, packing, pii, toxicity
from tallycrest.llm.common import held_out, table
from tallycrest.session import materialize

#: Near copies: sets of five words, Jaccard similarity of at least 0.8.
WORDS, PERCENT = 5, 80


def _with_columns_aside(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` after an operator that reads doc_id and text and may add or replace columns of any other name."""
    names = {c: c if c in ("doc_id", "text") else f"_source_{i}" for i, c in enumerate(docs.columns)}
    done = operator(docs.withColumnsRenamed(names))
    return done.select(*[F.col(held).alias(c) for c, held in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not scored as toxic; the model learns from labels that are not held out."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return _with_columns_aside(docs, lambda d: toxicity.score(d, model).filter("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: one with the smallest id.

    Rows without an id, or without words, are in no group and stay. Two texts under one id are told apart.
    """
    return _with_columns_aside(docs, lambda d: jaccard.drop_near_copies(d, WORDS, PERCENT))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark windows."""
    items = table(spark, sf_dir, "benchmark")
    return _with_columns_aside(docs, lambda d: decontaminate.contamination(d, items).filter("NOT contaminated"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars is that of the new text."""
    redacted = _with_columns_aside(docs, pii.redact)
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else redacted


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, with their ids."""
    return packing.offsets(packing.pack(docs)).select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Compression, tokenisers and discovered patterns are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
