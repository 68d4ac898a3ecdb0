"""One query for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycrest.llm import (
    chat,
    decontaminate,
    filter_audit,
    jaccard,
    langid,
    packing,
    pii,
    sharding,
    simhash,
    topk,
    toxicity,
    treap,
    urls,
)
from tallycrest.llm.common import held_out, table


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, from profiles of three quarters of them."""
    docs = table(spark, folder, "documents")
    model = langid.learn(docs.filter(~held_out()).select("text", "lang"))
    return langid.identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Five best inner products of every fiftieth vector with all others."""
    vectors = topk.integer_vectors(table(spark, folder, "embeddings"))
    return topk.top_k(vectors.filter("id % 50 = 0"), vectors, 5)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from three quarters of the labels."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, folder, "labels").filter(~held_out()))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


PROBE = r"\### Assistant: </turn> ok"


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations through the template and back, and one that holds its control strings."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = rows.sparkSession.range(0, 2, 1, 1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return chat.digests(chat.format_conversations(rows.unionByName(probe)))


def op5_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 contiguous shards of near equal bytes."""
    placed = sharding.shard_by_bytes(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut into pieces and packed into sequences of 2048 tokens."""
    summed = packing.with_checksums(
        packing.pack(table(spark, folder, "documents")).select(
            "doc_id", "start", "length", "doc_tokens", "sequence_id", "place", "ids"
        )
    )
    return packing.offsets(summed).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op7_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return urls.judge(table(spark, folder, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: validated spans, and those discovered by their contexts."""
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.KINDS),
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every document."""
    judged = decontaminate.contamination(
        table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark")
    )
    return judged.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op10_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents linked by 3-word n-gram sets with a Jaccard similarity of at least 0.9."""
    return jaccard.jaccard_groups(table(spark, folder, "documents"), words=3, percent=90)


def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose 4-word SimHash fingerprints differ at 4 bits or fewer."""
    return simhash.simhash_groups(table(spark, folder, "documents"), words=4, limit=4)


def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten documents of highest score for each benchmark item."""
    return treap.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 10)


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove at each step of all their orders, by language."""
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {
    "op1_language": op1_language,
    "op2_top_k": op2_top_k,
    "op3_toxicity": op3_toxicity,
    "op4_chat": op4_chat,
    "op5_shards": op5_shards,
    "op6_packing": op6_packing,
    "op7_urls": op7_urls,
    "op8_pii": op8_pii,
    "op9_decontaminate": op9_decontaminate,
    "op10_jaccard": op10_jaccard,
    "op11_simhash": op11_simhash,
    "op12_search": op12_search,
    "op13_filter_audit": op13_filter_audit,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES = {
    "op2_top_k": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        parts AS (SELECT vec_id, unnest(v) AS c, generate_subscripts(v, 1) AS d FROM usable),
        scores AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.c * b.c) AS BIGINT) AS score
            FROM parts a JOIN parts b ON a.d = b.d AND a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0 GROUP BY ALL
        ),
        ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r, vec_id, score
            FROM scores
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
    """,
    "op4_chat": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        e AS (
            SELECT *, regexp_replace(role, '([\\:<])', '\\\1', 'g') AS r,
                CASE WHEN contains(text, chr(10) || '</turn>' || chr(10)) OR ends_with(text, chr(10) || '</turn>')
                          OR regexp_matches(text, '\\(</turn>|### )')
                     THEN regexp_replace(text, '(\\*)(</turn>|### )', '\\\1\2', 'g') ELSE text END AS t
            FROM c
        ),
        g AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS lines,
                coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
                sum(4 + length(r) + 2 + length(t) + 9) AS chars
            FROM e GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
               sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
        FROM g
    """,
    "op9_decontaminate": f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM documents
        ),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM benchmark WHERE item_id IS NOT NULL
        ),
        windows AS (
            SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS k
            FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
                  FROM b WHERE len(w) > 0)
        ),
        lengths AS (SELECT DISTINCT n FROM windows),
        grams AS (
            SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS k
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n)
        ),
        hits AS (SELECT g.doc_id, g.s, g.n, x.item_id FROM grams g JOIN windows x ON g.n = x.n AND g.k = x.k),
        words AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
        ),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op10_jaccard": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[p : p + least(3, len(w)) - 1], ' ') AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
                              FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY ALL) o
            JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
            WHERE 100 * i >= 90 * (p.n + q.n - i)
        ),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
        FROM d LEFT JOIN n USING (doc_id)
        JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
    """,
    "op12_search": f"""
        WITH d AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
            FROM documents WHERE doc_id IS NOT NULL
        ),
        b AS (
            SELECT DISTINCT item_id, t FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
                FROM benchmark WHERE item_id IS NOT NULL)
        ),
        p AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
        n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY doc_id),
        c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
        w AS (
            SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM p, c GROUP BY t, docs
        ),
        m AS (SELECT doc_id, 10 + ((90 * n * docs) // total) AS m FROM n, c),
        s AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM b JOIN p USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY ALL
        ),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM s WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
    """,
    "op13_filter_audit": f"""
        WITH marks AS (
            SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
            FROM labels GROUP BY doc_id
        ),
        d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ),
        fails AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
                || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS f
            FROM d LEFT JOIN marks USING (doc_id)
        ),
        cells AS (
            SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM fails GROUP BY part, f
        ),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS o FROM x a, x b, x c, x d, x e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ),
        steps AS (SELECT o, CAST(i AS INTEGER) AS step, substr(o, i, 1) AS own FROM orders, range(1, 6) r(i)),
        counted AS (
            SELECT part, o, step, own,
                sum(CASE WHEN translate(f, left(o, step), '') = f THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN contains(f, own) AND translate(f, left(o, step - 1), '') = f THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN contains(f, own) AND translate(f, left(o, step - 1), '') <> f THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN f = own THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN contains(f, own) AND translate(f, left(o, step - 1), '') = f THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN contains(f, own) AND translate(f, left(o, step - 1), '') = f THEN toxic ELSE 0 END) AS toxic_lost
            FROM cells, steps GROUP BY part, o, step, own
        )
        SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM counted
    """,
}
