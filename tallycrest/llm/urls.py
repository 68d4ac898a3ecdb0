"""URL verdicts: listed rules first, then gradient-boosted trees on lexical features.

The trees learn from URLs that the rules label. All features are SQL expressions; training
and scoring are MLlib's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycrest.llm.common import ascii_lower
from tallycrest.session import materialize

#: (host and path, verdict)
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Labelled URLs that train the trees, about, for each verdict.
SAMPLE = 50_000
TREES, DEPTH, SEED = 20, 4, 7
FEATURES = (
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio",
    "entropy", "parameters", "hyphens", "suffix_share", "suffix_blocked",
)


def parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host and path; null, or no ``://``: both empty."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*+", 0)
    return pages.withColumns({"host": ascii_lower(host), "path": path})


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    own = (F.col("host") == host) | F.col("host").endswith("." + host)
    return own & F.col("path").startswith(slash + path)


def match_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``rule`` and ``listed`` (its verdict) of the longest rule that fits, else null."""
    rule = listed = None
    for text, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        fits = _fits(text)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        listed = F.when(fits, verdict) if listed is None else listed.when(fits, verdict)
    none = F.lit(None).cast("string")
    return pages.withColumns({"rule": none if rule is None else rule, "listed": none if listed is None else listed})


def features(pages: DataFrame, suffixes: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` (with host and path) with the lexical features."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    length = F.greatest(F.length(text), F.lit(1)).cast("double")

    def count(pattern: str, of: Column = text) -> Column:
        return F.regexp_count(of, F.lit(pattern)).cast("double")

    shares = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: F.when(c == "", F.lit(0.0)).otherwise(
            (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("double") / length
        ),
    )
    entropy = F.aggregate(shares, F.lit(0.0), lambda a, p: F.when(p > 0, a - p * F.log2(p)).otherwise(a))
    return (
        pages.withColumns(
            {
                "url_length": length,
                "host_length": F.length("host").cast("double"),
                "path_length": F.length("path").cast("double"),
                "host_depth": count("[.]", F.col("host")),
                "path_depth": count("/", F.col("path")),
                "digit_ratio": count("[0-9]") / length,
                "entropy": F.coalesce(entropy, F.lit(0.0)),
                "parameters": count("[?&][^?&=#]+="),
                "hyphens": count("-", F.col("host")),
                "suffix": suffix(),
            }
        )
        .join(suffixes, "suffix", "left")
        .fillna(0.0, ["suffix_share", "suffix_blocked"])
        .drop("suffix")
    )


def suffix() -> Column:
    return F.element_at(F.split(F.col("host"), "[.]"), -1)


def suffix_statistics(pages: DataFrame) -> DataFrame:
    """Share of all URLs and smoothed share of blocked labelled URLs, by the host's last label."""
    one = pages.groupBy(suffix().alias("suffix")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("listed").alias("labelled"),
        F.count(F.when(F.col("listed") == "block", 1)).alias("blocked"),
    )
    total = one.agg(F.sum("n").alias("total"))
    return one.join(F.broadcast(total)).select(  # one row
        "suffix",
        (F.col("n") / F.col("total")).alias("suffix_share"),
        ((F.col("blocked") + 1) / (F.col("labelled") + 2)).alias("suffix_blocked"),
    )


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """``pages`` with host, path, rule, verdict and ``block_score`` (null where a rule decides).

    About ``sample`` different URLs of each verdict, chosen by hash, train the trees; c copies of a URL weigh
    1 + ln c. Suffix statistics are taken over all pages. If the rules give only one verdict, it is everyone's; without any
    labelled URL all others are allowed. Null and odd URLs have empty host and path, no rule, and
    are scored like others. Repeated rows are judged each; columns of ``pages`` that clash with
    an added one are replaced.
    """
    added = ("host", "path", "rule", "listed", "verdict", "block_score", "suffix", "_x", *FEATURES)
    pages = match_rules(parts(pages.drop(*added)), rules)
    suffixes = materialize(suffix_statistics(pages.select("host", "listed")), "url-suffixes")
    draw = F.pmod(F.xxhash64("url"), F.lit(1 << 30)).cast("double") / (1 << 30)
    # copies of a URL are one row, so that none is a large share of the sample
    known = (
        pages.filter("listed IS NOT NULL").groupBy("url")
        .agg(*[F.first(c).alias(c) for c in ("host", "path", "listed")], F.count(F.lit(1)).alias("copies"))
        .withColumn("draw", draw)
    )
    counts = {
        r["listed"]: (r["n"], r["least"])
        for r in known.groupBy("listed").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("least")).collect()
    }
    if len(counts) < 2:
        only = next(iter(counts), "allow")
        return pages.withColumn("verdict", F.coalesce("listed", F.lit(only))).withColumn(
            "block_score", F.lit(None).cast("double")
        ).drop("listed")
    limit = F.lit(0.0)
    for verdict, (n, least) in counts.items():  # at least the URL of the smallest draw
        limit = F.when(F.col("listed") == verdict, max(sample / n, least)).otherwise(limit)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_x")
    chosen = known.filter(F.col("draw") <= limit).select("url", "host", "path", "listed", "copies")
    train = materialize(
        features(chosen, suffixes).select(
            *FEATURES, (F.col("listed") == "block").cast("double").alias("label"), (1 + F.log("copies")).alias("weight")
        ),
        "url-sample",
    )
    model: GBTClassificationModel = GBTClassifier(
        featuresCol="_x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED
    ).fit(assembler.transform(train))
    model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_p")
    scored = model.transform(assembler.transform(features(pages, suffixes)))
    score = vector_to_array("_p")[1]
    return (
        scored.withColumn("block_score", F.when(F.col("listed").isNull(), score))
        .withColumn(
            "verdict", F.coalesce("listed", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
        )
        .drop("listed", "_x", "_p", *FEATURES)
    )
