"""Personal data: validated patterns, and spans discovered by bootstrapping on their contexts.

The validated spans (base) are the seeds. Words around a seed form lexical patterns; a
pattern and the strings found in its place make a bipartite graph over the whole corpus. Spark
scores both sides in turn: a pattern by the mean confidence of its instances, an instance by
the patterns that hold it. Strings that look like identifiers, are no seed, and stand in
patterns of high confidence are added, and are seeds of further patterns in the next round.
All of it is SQL expressions and joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycrest.session import materialize

#: In the order in which spans of equal start are listed.
KINDS = ("email", "ip", "card", "phone")
#: Leftmost, non-overlapping. A run is entered at its first character only and never given
#: back (possessive), which finds what plain patterns find and keeps long runs linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_VALUE = r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(?:\.0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)){3}$"
#: A word with a digit or an at sign.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Two or more neighbouring groups of digits and capitals, as numbers are written in groups; a bank's
#: four letters may stand between two of them. A mark that ends a phrase ends the run.
GROUP = r"[^\s\p{Ll}0-9@]*+[0-9][^\s\p{Ll}@]*+(?!\S)"
RUN = rf"(?<!\S){GROUP}(?:(?<![.,;:!?])\x20(?:[A-Z]{{4}}\x20)?+{GROUP})++"
#: Longer words are looked for inside runs, too.
LONG = r"(?<!\S)(?=\S{6})[^\s0-9@]*+[0-9@]\S*+"

#: Rounds of scoring, and what a pattern needs to discover anything: its score, and its number of
#: different instances that are seeds or discovered.
ROUNDS, SCORE, SEEDS = 3, 0.7, 5
#: Characters around a span in which its context words are looked for.
NEAR = 80

SPAN = "struct<start:long,rank:int,stop:long,kind:string>"


#: Elements of an array that are added up one by one, and characters of a piece of a text.
BLOCK, PIECE = 64, 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, merge: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """For every element of an array of longs (0 or more) the merged elements before it, 0 for the first.

    Blocks are merged first, then their totals in the same way, so the work for an element does not
    grow with the array (but for the few totals of the last level).
    """

    def merged(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), merge)

    def before(part: Column) -> Column:
        return F.transform(part, lambda _, i: merged(F.slice(part, 1, i)))

    if not levels:
        return before(values)
    last = F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * BLOCK + 1, BLOCK))

    def joined(parts: Column) -> Column:
        return _let(
            F.transform(parts, merged),
            lambda totals: F.flatten(
                F.zip_with(
                    parts,
                    _running(totals, merge, levels - 1),
                    lambda part, so_far: F.transform(before(part), lambda x: merge(so_far, x)),
                )
            ),
        )

    return _let(blocks, joined)


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _between(pieces: Column, start: Column, stop: Column) -> Column:
    """Characters start to stop (exclusive, may be past the end) of a text in pieces; reads no other piece."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor(F.greatest(stop - 1, start) / PIECE).cast("int")
    near = F.array_join(F.transform(F.sequence(first, last), lambda k: F.get(pieces, k)), "")
    return F.substr(near, (start - first * PIECE + 1).cast("int"), (stop - start).cast("int"))


def _found(text: Column, pattern: str) -> Column:
    """start, stop and string of every match, in code points."""
    strings = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(parts: Column) -> Column:
        widths = F.transform(parts, lambda p: p["gap"] + F.length(p["string"]))
        starts = _let(widths, lambda w: _running(w, lambda x, y: x + y))
        return F.zip_with(
            parts,
            starts,
            lambda p, at: F.struct(
                (at + p["gap"]).alias("start"),
                (at + p["gap"] + F.length(p["string"])).alias("stop"),
                p["string"].alias("string"),
            ),
        )

    parts = _let(
        strings,
        lambda found: F.zip_with(
            F.slice(gaps, 1, F.size(found)),
            found,
            lambda g, s: F.struct(F.length(g).cast("long").alias("gap"), s.alias("string")),
        ),
    )
    return _let(parts, placed)


def _digits(string: Column) -> Column:
    return F.regexp_replace(string, "[^0-9]", "")


def _luhn(string: Column) -> Column:
    """Every second digit from the right doubled, its digits added; the sum divides by ten."""
    digits = F.reverse(F.filter(F.split(_digits(string), ""), lambda d: d != ""))
    values = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def base_spans(text: Column) -> Column:
    """Validated spans of a non-null text, by start and kind."""
    digit = text.rlike("[0-9]")
    dotted = F.contains(text, F.lit("."))
    checks = {
        "email": (EMAIL, F.contains(text, F.lit("@")), lambda s: F.lit(True)),
        "ip": (IP, digit & dotted, lambda s: s.rlike(IP_VALUE)),
        "card": (CARD, digit, _luhn),
        "phone": (PHONE, F.contains(text, F.lit("+")), lambda s: F.length(_digits(s)).between(9, 15)),
    }
    lists = [_valid(text, rank, kind, *checks[kind]) for rank, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*lists))


def _valid(text: Column, rank: int, kind: str, pattern: str, may: Column, valid: Callable[[Column], Column]) -> Column:
    kept = F.filter(_found(text, pattern), lambda m: valid(m["string"]))
    named = F.transform(
        kept,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["stop"].alias("stop"), F.lit(kind).alias("kind")
        ),
    )
    return F.when(may, named).otherwise(F.array().cast(f"array<{SPAN}>"))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}0-9@]+"), lambda w: w != "")


#: Where a mention comes from: a validated span; a run, or a word outside runs; a longer word.
SEED, WHOLE, INNER = 0, 1, 2


def _candidates(text: Column, pattern: str, level: int) -> Column:
    """start, stop, kind (null) and level of the matches, without punctuation at their ends."""
    edge = r"[\p{Punct}]"
    named = F.filter(
        _found(text, pattern), lambda m: F.regexp_replace(m["string"], f"^{edge}++|{edge}++$", "").rlike("[0-9@]")
    )
    return F.transform(
        named,
        lambda m: F.struct(
            (m["start"] + F.length(F.regexp_extract(m["string"], f"^{edge}*+", 0))).alias("start"),
            (m["stop"] - F.length(F.regexp_extract(m["string"], f"{edge}*$", 0))).alias("stop"),
            F.lit(None).cast("string").alias("kind"),
            F.lit(level).alias("level"),
        ),
    )


def _mentions(text: Column) -> Column:
    """Seeds and identifier-like strings: start, stop, kind (null: unknown), level, string, patterns."""
    seeds = F.transform(
        base_spans(text),
        lambda s: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"), F.lit(SEED).alias("level")
        ),
    )
    found = F.concat(seeds, _candidates(text, f"{RUN}|{TOKEN}", WHOLE), _candidates(text, LONG, INNER))

    def described(pieces: Column, m: Column) -> Column:
        before = _words(_between(pieces, F.greatest(m["start"] - NEAR, F.lit(0).cast("long")), m["start"]))
        after = _words(_between(pieces, m["stop"], m["stop"] + NEAR))
        patterns = _let(F.struct(before.alias("before"), after.alias("after")), _patterns)
        return F.struct(
            m["start"].alias("start"),
            m["stop"].alias("stop"),
            m["kind"].alias("kind"),
            m["level"].alias("level"),
            _between(pieces, m["start"], m["stop"]).alias("string"),
            patterns.alias("patterns"),
        )

    return _let(_pieces(text), lambda pieces: F.transform(found, lambda m: described(pieces, m)))


def _patterns(words: Column) -> Column:
    """Two words before; one word before and one after."""
    before, after = words["before"], words["after"]
    left = F.array_join(F.slice(before, F.greatest(F.size(before) - 1, F.lit(1)), 2), " ")
    last = F.coalesce(F.get(before, F.size(before) - 1), F.lit(""))
    following = F.coalesce(F.get(after, F.lit(0)), F.lit(""))
    patterns = F.array(
        F.when(F.size(before) >= 2, F.concat(left, F.lit(" _"))),
        F.when((last != "") & (following != ""), F.concat(last, F.lit(" _ "), following)),
    )
    return F.filter(patterns, lambda p: p.isNotNull())


def _untouched(found: DataFrame) -> DataFrame:
    """The seeds, and the other mentions that touch no seed of their text; a longer word that starts with a
    whole mention has the run's context, and is no mention of its own."""
    rows = Window.partitionBy("key")
    seed = F.col("level") == SEED
    reached = F.max(F.when(seed, F.col("stop"))).over(rows.orderBy("start"))
    coming = F.min(F.when(seed, F.col("start"))).over(rows.orderBy(F.desc("start")))
    free = (F.coalesce(reached, F.lit(0)) <= F.col("start")) & F.coalesce(coming >= F.col("stop"), F.lit(True))
    whole = F.max(F.col("level") == WHOLE).over(Window.partitionBy("key", "start"))
    return (
        found.withColumn("free", seed | free)
        .filter("free")
        .withColumn("whole", whole)
        .filter((F.col("level") != INNER) | ~F.col("whole"))
        .drop("level", "free", "whole")
    )


def scored_patterns(edges: DataFrame) -> DataFrame:
    """pattern, kind, score, seeds of the patterns that may discover.

    ``edges``: distinct pattern, string, kind (null for strings that are no seed). A pattern's
    score for a kind is the mean confidence of its instances, with two instances of none added;
    an instance's confidence is 1 for its own kind as a seed, else 1 - product(1 - score) over
    its patterns. Every round lists all patterns that hold a seed, or an instance of a pattern
    that may discover: such an instance counts among the seeds. Scores are stored after every round.
    """
    edges = materialize(edges, "pii-edges")
    totals = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("all"))
    direct = edges.filter("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("direct"))
    scores = materialize(
        direct.join(totals, "pattern").withColumn("seeds", F.col("direct")).withColumn(
            "score", F.col("seeds") / (F.col("all") + 2)
        ),
        "pii-patterns",
    )
    direct = scores.select("pattern", "kind", "direct")
    may = (F.col("score") >= SCORE) & (F.col("seeds") >= SEEDS)
    unknown = edges.filter("kind IS NULL").select("pattern", "string")
    for _ in range(ROUNDS - 1):
        confidence = (
            unknown.join(scores.select("pattern", "kind", "score", may.alias("may")), "pattern")
            .groupBy("string", "kind")
            .agg(F.sum(F.log(1 - F.least(F.col("score"), F.lit(0.999)))).alias("doubt"), F.max("may").alias("sure"))
            .select("string", "kind", (1 - F.exp("doubt")).alias("confidence"), "sure")
        )
        gained = (
            unknown.join(confidence, "string")
            .groupBy("pattern", "kind")
            .agg(F.sum("confidence").alias("gained"), F.count_if("sure").alias("found"))
        )
        first, more = F.coalesce("direct", F.lit(0)), F.coalesce("gained", F.lit(0.0))
        scores = materialize(
            direct.join(gained, ["pattern", "kind"], "full")
            .withColumn("seeds", first + F.coalesce("found", F.lit(0)))
            .filter("seeds > 0")
            .join(totals, "pattern")
            .select("pattern", "kind", "seeds", "all", ((first + more) / (F.col("all") + 2)).alias("score")),
            "pii-patterns",
        )
    return scores.filter(may)


def _key() -> Column:
    """A row by its id and a hash of its text; repeated rows have the same spans."""
    own = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    return F.concat(F.hex(F.xxhash64(F.coalesce("text", F.lit("")))), own)


def discovered(docs: DataFrame) -> DataFrame:
    """key and ``added`` spans of the documents in which bootstrapping finds any."""
    rows = docs.select("doc_id", "text").filter("text RLIKE '[0-9@]'").withColumn("key", _key())
    found = rows.select("key", F.explode(_mentions(F.col("text"))).alias("m")).select("key", "m.*").distinct()
    found = materialize(_untouched(found), "pii-mentions")
    links = found.select("key", "start", "stop", "kind", "string", F.explode("patterns").alias("pattern"))
    good = scored_patterns(links.select("pattern", "string", "kind").distinct())
    hits = links.filter("kind IS NULL").drop("kind").join(good.select("pattern", "kind", "score"), "pattern")
    best = hits.groupBy("key", "start", "stop").agg(F.max(F.struct("score", "kind")).alias("best"))
    # a word found inside a found run is part of it
    earlier = Window.partitionBy("key").orderBy("start", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    best = best.withColumn("reached", F.max("stop").over(earlier)).filter("reached IS NULL OR reached < stop")
    ranks = F.create_map(*[F.lit(x) for rank, kind in enumerate(KINDS) for x in (kind, rank)])
    return best.groupBy("key").agg(
        F.collect_list(
            F.struct(
                F.col("start"),
                ranks[F.col("best.kind")].cast("int").alias("rank"),
                F.col("stop"),
                F.col("best.kind").alias("kind"),
            )
        ).alias("added")
    )


def find(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``base`` and ``spans``: arrays of (start, rank, stop, kind), by start and kind.

    Offsets are code points, stop exclusive. ``spans`` holds all base spans and the discovered
    ones, which overlap none of them. A null or empty text has no spans. Repeated rows get the
    same spans (rows are told apart by id and a hash of the text); columns of ``docs`` that clash with
    an added one are replaced. The work for a text grows with its length and its matches, not their
    product. Texts are not shuffled unless discovered spans are too many for Spark to send to all tasks.
    """
    docs = docs.drop("base", "spans", "added", "key")
    new = materialize(discovered(docs), "pii-added")
    text = F.coalesce(F.col("text"), F.lit(""))
    empty = F.array().cast(f"array<{SPAN}>")
    return (
        docs.withColumn("key", _key())
        .join(new, "key", "left")
        .withColumn("base", F.when(text.rlike("[0-9@]"), base_spans(text)).otherwise(empty))
        .withColumn("spans", F.array_sort(F.concat("base", F.coalesce("added", empty))))
        .drop("key", "added")
    )


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in angle brackets.

    Of overlapping spans the first names the replacement, which covers them all. Null stays null.
    """
    found = find(docs)

    def replaced(pieces: Column) -> Column:
        stops = F.transform("spans", lambda s: s["stop"])
        parts = F.zip_with(
            "spans",
            _let(stops, lambda x: _running(x, lambda a, b: F.greatest(a, b))),
            lambda s, at: F.when(
                s["start"] >= at,
                F.concat(_between(pieces, at, s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")),
            ).otherwise(F.lit("")),
        )
        end = F.length("text").cast("long")
        return F.concat(F.array_join(parts, ""), _between(pieces, F.array_max(stops), end))

    text = F.when(F.size("spans") > 0, _let(_pieces(F.col("text")), replaced)).otherwise(F.col("text"))
    return found.withColumn("text", text).drop("base", "spans")
