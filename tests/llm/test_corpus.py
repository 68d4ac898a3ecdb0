"""The corpus operators against plain Python, on small frames with awkward rows."""

import hashlib
import itertools
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from compare import database, differences
from tallycrest.llm import chat, decontaminate, jaccard, langid, packing, pii, sharding, topk, toxicity, urls
from tallycrest.llm import queries as corpus

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, extra=""):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash")).withColumn("n", F.lit(1))


def docs_of(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


ODD = [(None, "no id"), (1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "a"), (5, "é 😀 İ"), (6, "x" * 200_000), (7, "7 7 " * 30_000)]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", sorted(corpus.ORACLES))
def test_equals_sql(spark, name):
    got = corpus.QUERIES[name](spark, FOLDER).toPandas()
    assert differences(got, database(FOLDER).execute(corpus.ORACLES[name]).df()) == ""


# language


def test_language_held_out_accuracy(spark):
    got = corpus.op1_language(spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(lang, "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_a_bundle_is_the_plain_sum_of_bound_letters():
    text = "Ab, c"
    letters = " ab c "
    plain = np.zeros(langid.DIMENSIONS)
    for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
        v = [langid.letter_vector(ord(x)).astype(int) for x in (a, b, c)]
        plain += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    bundles, counts = langid._bundles([text, None])
    assert (bundles[0] == plain).all() and counts.tolist() == [4, 0]


def test_language_of_odd_rows(spark, odd, empty):
    model = langid.learn(odd)
    got = {r["doc_id"]: r for r in langid.identify(odd, model).collect()}
    assert {got[i]["lang_pred"] for i in (1, 2, 3, 7)} == {"und"} and got[6]["lang_pred"] == "en"
    assert langid.learn(empty) == {} and langid.identify(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, {}).collect()} == {"und"}


# search


def test_top_k_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(300)]
    vectors += [(400, [0.1] * 8), (401, [0.1] * 8), (402, []), (403, [0.5]), (404, None), (405, [None] * 8)]
    vectors += [(406, [float("nan")] * 8), (407, [float("inf")] * 8), (None, [0.1] * 8), (408, [2.0**40] * 8), (100, [0.3] * 8)]
    df = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<float>, score string")
    usable = topk.integer_vectors(df)
    known = [(r["id"], r["v"]) for r in usable.collect()]
    assert {404, 405, 406, 407, None}.isdisjoint(i for i, _ in known)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(usable.filter("id % 50 = 0"), usable, 5).collect()}
    asked = {}
    for i, v in known:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in known if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in scores]
    assert topk.top_k(usable.limit(0), usable.limit(0)).count() == 0


def test_max_score_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    rows = rng.integers(-60, 60, (2000, 16))
    shard = topk.Shard(np.arange(2000), rows)
    q = rows[7]
    exact = sorted(((-int(rows[i] @ q)), i) for i in range(2000) if i != 7)[:5]
    at, score = shard.search(7, q, 5, None)
    assert [(-s, i) for i, s in zip(at.tolist(), score.tolist(), strict=True)] == exact
    at, _ = shard.search(7, q, 5, -exact[2][0])  # with a floor, only rows that reach it
    assert at.tolist() == [i for s, i in exact if -s >= -exact[2][0]]


# toxicity


def test_toxicity_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = corpus.op3_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = got.filter("held_out AND toxic IS NOT NULL").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    above = np.mean([(a > b) + (a == b) / 2 for a in toxic for b in clean])
    assert above > 0.85  # a few hundred toxic training texts; held-out figures of larger tables are in README
    assert all((r["score"] >= 0.3) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_of_odd_rows(spark, odd, empty):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(200)]
    plain = [" ".join(rng.choice(words, 60)) for _ in range(200)]
    bad = [" ".join(x for w in rng.choice(words, 60) for x in ([w, "zznasty"] if rng.random() < 0.1 else [w])) for _ in range(60)]
    model = toxicity.fit(bad, plain, 0.2)
    got = toxicity.score(odd, model)
    assert got.count() == len(ODD) and got.filter("score BETWEEN 0 AND 1").count() == len(ODD)
    two = frame(spark, [(1, bad[0] + " zznasty is zznasty"), (2, plain[0])])
    assert [r["predicted"] for r in toxicity.score(two, model).orderBy("doc_id").collect()] == [1, 0]
    assert toxicity.score(empty, model).count() == 0
    assert {r["score"] for r in toxicity.score(odd, None).collect()} == {0.0}
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.learn(odd, labels) is None


# chat


def test_chat_round_trip(spark):
    texts = ["", None, "\\", "\\\\</turn>", "\n</turn>\n", "x\n</turn>", "### user: hi", "\\### ", "</turn>\n### a: b\n</turn>\n", "😀é"]
    roles = ["user", "assistant", None, "a: b\\<c", "x\n</turn>\n### y"]
    rows = [(i, k, r, t) for i, (r, s) in enumerate(itertools.product(roles, roles)) for k, (r, t) in enumerate(itertools.product([r, s], texts))]
    rows += [(999, None, "user", "first"), (999, 2, "b", "tie"), (999, 2, "a", "tie"), (999, 2, "a", "tie"), (None, 1, "assistant", "z" * 100_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, rendered int")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    for conv, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), key=lambda r: r[0]):
        turns = sorted(((k is not None, k or 0, r or "", t or "") for _, k, r, t in group))
        source = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        own = got[conv]
        assert own["n_turns"] == len(turns)
        assert own["turns_sha256"] == hashlib.sha256(source.encode()).hexdigest()
        assert (own["loss_chars"], own["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_conversations(df.limit(0)).count() == 0


# shards


def test_shards(spark, odd, empty):
    for docs, rows in ((odd, ODD), (spark.read.parquet(f"{FOLDER}/documents.parquet"), docs_of(spark))):
        got = sharding.shard_by_bytes(docs).collect()
        assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted(
            (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows
        )
        order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
        ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in order]
        assert ids == sorted(ids)  # contiguous
        total, before = sum(r["size"] for r in got), 0
        for shard, group in itertools.groupby(order, key=lambda r: r["shard"]):
            group = list(group)
            assert [r["slot"] for r in group] == list(range(len(group)))
            for r in group:
                assert shard == min(15, (2 * before + r["size"]) * 16 // (2 * total))
                before += r["size"]
    assert sharding.shard_by_bytes(empty).count() == 0


# packing


def test_words_give_the_tokenizer_s_ids(spark):
    encoder = packing.encoder()
    texts = [t or "" for _, t in docs_of(spark) + ODD[:7]]
    texts += ["a  b   c", " lead", "trail ", "\n \n x", "a\u00a0 b", "é è", "it's we'll 12 34", "x<|endoftext|> y", "a \x1c b", "a\x1c b c"]
    whole = [encoder.whole.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):  # new words, then remembered ones
        assert [x.tolist() for x in encoder.ids(texts)] == whole


def test_cut_lengths():
    for n in range(1, 6000):
        cut = packing.cut_lengths(n)
        assert sum(cut) == n and all(0 < x <= 2048 for x in cut)
        assert all(2048 - (2048 // x) * x <= packing.SLACK for x in cut)


@pytest.mark.parametrize("which", ["odd", "given"])
def test_packing(spark, odd, which, tmp_path):
    docs = odd if which == "odd" else spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = ODD if which == "odd" else docs_of(spark)
    got = packing.offsets(packing.pack(docs)).collect()
    whole = sorted(
        (tuple(x.tolist()) + (1,) for x in packing.encoder().ids([t or "" for _, t in rows])), key=lambda x: (len(x), x)
    )
    assert sum(r["length"] for r in got) == sum(map(len, whole))
    assert all(len(r["ids"]) == r["length"] for r in got)
    by = itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"])
    used = 0
    for i, (sequence, group) in enumerate(by):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert sequence == i and at <= 2048
        used += 1
    assert sum(map(len, whole)) / (2048 * used) > 0.9 or used <= 2
    if which == "given":  # ids are unique there: pieces join to the document
        pieces = {}
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == len(pieces.setdefault(r["doc_id"], []))
            pieces[r["doc_id"]] += r["ids"]
        assert sorted(map(tuple, pieces.values()), key=lambda x: (len(x), x)) == whole


def test_packing_nothing(spark, empty):
    assert packing.offsets(packing.pack(empty)).count() == 0


# urls


def judge_rule(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in urls.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] if best else ""):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


def test_urls(spark):
    given = [None, "", "no scheme", "http://", "://COM/", "http://A.Example.com/en/1", "http://www.example.com/en/", "http://xexample.com/en/x"]
    given += ["http://example.com?x=://net/es/", "a://b.net/es/?q", "a://b.net/es", "a://É.NET/fr/1#z", "x://y://z/es/", "h://a.org/" + "q" * 5000]
    given += [f"http://m{i}.example.{t}/{lang}/{i}?a={i}&b" for i in range(20) for t in ("com", "net", "org") for lang in ("en", "fr")] * 2
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(given)], "page_id long, url string, rule string")
    got = urls.judge(df).orderBy("page_id").collect()
    assert len(got) == len(given)
    for r, url in zip(got, given, strict=True):
        host, path, rule, verdict = judge_rule(url)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")
    assert urls.judge(df.limit(0)).count() == 0
    assert {r["verdict"] for r in urls.judge(df.filter("page_id < 4")).collect()} == {"allow"}


def test_url_trees_carry_the_rules_over(spark):
    """Unlisted hosts are judged by the shape that listed ones have."""
    blocked, allowed = "/es/{0}{0}{0}?a={0}&b={0}&c={0}", "/about-us/our-story"
    given = [f"http://a{i}.net{blocked.format(i)}" for i in range(60)] + [f"http://b{i}.com{allowed}" for i in range(60)]
    asked = [f"http://c{i}.org{blocked.format(i + 7)}" for i in range(20)] + [f"http://d{i}.org{allowed}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(given + asked)), "page_id long, url string")
    got = [r["verdict"] for r in urls.judge(df).orderBy("page_id").collect()]
    assert got == ["block"] * 60 + ["allow"] * 60 + ["block"] * 20 + ["allow"] * 20


# personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for rank, kind in enumerate(pii.KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = [int(x) for x in re.sub("[^0-9]", "", m.group())]
            luhn = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


TRICKY = [
    "a@b.c@d.e", "a@b.c%x@d.e-f.g", "1.2.3.4.5.6.7.8", "999.1.2.3.4", "0255.0.0.1 256.1.1.1", "1.2.3.4é5.6.7.8",
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111111", "5  4111111111111111", "1-4111111111111111",
    "+1 (456) 555-2186. +12 +1+1234567890", "😀 x@y.zz 😀 +49 30 1234567", "..@a.b", "a@b", "+1 456 555 2186 5", "0" * 30,
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4", "x@" + "a." * 3000 + "b", "1." * 5000, "1 " * 5000,
]


def test_base_spans(spark, odd, empty):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(i + 100, t) for i, t in docs_of(spark)]
    got = {r["doc_id"]: r for r in pii.find(frame(spark, rows)).collect()}
    for i, text in rows:
        assert [tuple(s) for s in got[i]["base"]] == plain_spans(text), text
    assert all(not r["base"] for r in pii.find(odd).collect())
    assert pii.find(empty).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"word{chr(97 + i)} please write to user{i}@mail.com today") for i in range(20)]
    rows += [(50, "and please write to jane(at)mail77 today"), (51, "a number 123456x alone")]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find(frame(spark, rows)).collect()}
    start = rows[20][1].index("jane")
    assert got[50] == [(start, 0, start + len("jane(at)mail77"), "email")]
    assert got[51] == [] and len(got[3]) == 1


def test_discovered_instances_lead_to_further_patterns(spark):
    rows = [(i, f"please write to user{i}@mail.com today") for i in range(30)]
    rows += [(30 + i, f"please write to jane{i}(at)mail today and badge holder jane{i}(at)mail, ok") for i in range(10)]
    rows += [(50, "our badge holder zed(at)mail99, ok"), (51, "our badge number zed(at)mail98, no")]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find(frame(spark, rows)).collect()}
    start = rows[40][1].index("zed")
    assert got[50] == [(start, 0, start + len("zed(at)mail99"), "email")]
    assert got[51] == [] and all(len(got[30 + i]) == 2 for i in range(10))


def test_numbers_in_groups_and_short_ids_are_discovered(spark):
    unseen = ["030 1234 567", "4111 1111 1111 1112", "GB29 NWBK 6016 1331 9268 19", "AB123"]
    rows = [(i, f"please call now +49 30 1234{100 + i} thanks") for i in range(20)]
    rows += [(50 + i, f"please call now {x} thanks") for i, x in enumerate(unseen)] + [(60, "in 2020. 30 went, 5 1 left")]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find(frame(spark, rows)).collect()}
    assert [got[50 + i] for i in range(4)] == [[(16, 3, 16 + len(x), "phone")] for x in unseen]
    assert got[60] == []


def plain_bootstrap(rows):
    """All spans of every row, by the rules of the module's docstrings."""
    punct = r"[!-/:-@\[-`{-~]"
    mentions = []  # row, start, stop, kind, string, patterns
    for row, (_, text) in enumerate(rows):
        seeds = plain_spans(text)

        def free(pattern, text=text, seeds=seeds):
            for m in regex.finditer(pattern, text):
                start = m.start() + len(regex.match(f"{punct}*", m.group()).group())
                stop = m.start() + len(regex.sub(f"{punct}+$", "", m.group()))
                if start < stop and not any(a < stop and start < b for a, _, b, _ in seeds):
                    if re.search("[0-9@]", text[start:stop]):
                        yield start, stop, None

        whole = list(free(f"{pii.RUN}|{pii.TOKEN}"))
        inner = [m for m in free(pii.LONG) if m[0] not in {w[0] for w in whole}]
        for start, stop, kind in [(a, b, k) for a, _, b, k in seeds] + whole + inner:
            before = regex.findall(r"[\p{L}0-9@]+", text[max(0, start - pii.NEAR) : start].lower())
            after = regex.findall(r"[\p{L}0-9@]+", text[stop : stop + pii.NEAR].lower())
            patterns = [" ".join(before[-2:]) + " _"] if len(before) > 1 else []
            patterns += [f"{before[-1]} _ {after[0]}"] if before and after else []
            mentions.append((row, start, stop, kind, text[start:stop], patterns))
    edges = {(p, m[4], m[3]) for m in mentions for p in m[5]}
    every = Counter(p for p, _, _ in edges)
    direct = Counter((p, k) for p, _, k in edges if k)
    scores = {pk: (n / (every[pk[0]] + 2), n) for pk, n in direct.items()}
    for _ in range(pii.ROUNDS - 1):
        doubt, sure = defaultdict(lambda: 1.0), defaultdict(bool)
        for p, x, kind in edges:
            for k in pii.KINDS:
                if kind is None and (p, k) in scores:
                    score, n = scores[p, k]
                    doubt[x, k] *= 1 - min(score, 0.999)
                    sure[x, k] |= score >= pii.SCORE and n >= pii.SEEDS
        gained, found = Counter(), Counter()
        for p, x, kind in edges:
            for k in pii.KINDS:
                if kind is None and (x, k) in doubt:
                    gained[p, k] += 1 - doubt[x, k]
                    found[p, k] += sure[x, k]
        scores = {
            pk: ((direct[pk] + gained[pk]) / (every[pk[0]] + 2), direct[pk] + found[pk])
            for pk in {*direct, *gained}
            if direct[pk] + found[pk] > 0
        }
    good = {pk: score for pk, (score, n) in scores.items() if score >= pii.SCORE and n >= pii.SEEDS}
    best = {}
    for row, start, stop, kind, _, patterns in mentions:
        for p in patterns:
            for k in pii.KINDS:
                if kind is None and (p, k) in good:
                    best[row, start, stop] = max(best.get((row, start, stop), (0, "")), (good[p, k], k))
    out = [plain_spans(text) for _, text in rows]
    for (row, start, stop), (_, kind) in best.items():
        if not any(r == row and a <= start and stop <= b and b - a > stop - start for r, a, b in best):
            out[row].append((start, pii.KINDS.index(kind), stop, kind))
    return [sorted(x) for x in out]


def test_bootstrap_equals_plain_python(spark):
    rng = np.random.default_rng(11)
    leads = ["write to", "mail me at", "please call", "badge holder", "room number", "paid with"]
    rows = []
    for i in range(300):
        parts = []
        for _ in range(int(rng.integers(1, 6))):
            value = [f"u{i}@mail.com", f"+49 30 {rng.integers(10**6, 10**7)}", f"a{i}(at)mail", f"{i} {i * 7} {i * 13}", f"X{i}"]
            lead = int(rng.integers(0, 6))
            own = value[int(rng.integers(0, 5))] if rng.random() < 0.2 else value[(0, 0, 1, 2, 4, 3)[lead]]
            parts.append(f"{leads[lead]} {own}{rng.choice(['', ',', ' today', '. Now'])}")
        rows.append((i, " ".join(parts)))
    rows += [(7, rows[8][1]), (7, rows[7][1]), (None, rows[9][1])]  # one id with two texts, a repeated row, no id
    want = plain_bootstrap(rows[:301] + rows[302:])  # repeated rows are one instance
    want.insert(301, want[7])
    got = pii.find(frame(spark, rows).withColumn("at", F.monotonically_increasing_id())).orderBy("at").collect()
    assert [[tuple(s) for s in r["spans"]] for r in got] == want
    assert sum(len(r["spans"]) - len(r["base"]) for r in got) > 20


def test_many_matches_in_one_text(spark):
    texts = ["ab 12 " * 50_000, "+49 30 1234567 x@y.zz " * 9_000]
    began = time.monotonic()
    got = pii.find(frame(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert time.monotonic() - began < 120  # a quadratic search takes an hour
    assert got[0]["spans"] == [] and len(got[1]["spans"]) == 18_000
    assert [tuple(s)[::2] for s in got[1]["spans"][-2:]] == [(22 * 8_999, 22 * 8_999 + 14), (22 * 8_999 + 15, 22 * 9_000 - 1)]


def test_redaction(spark):
    got = pii.redact(frame(spark, [(1, "😀 x@y.zz, 1.2.3.4"), (2, None), (3, "+4041894974608795 z")])).orderBy("doc_id").collect()
    assert got[0]["text"] == "😀 <EMAIL>, <IP>" and got[1]["text"] is None
    assert got[2]["text"] == "+<CARD> z"


# decontamination


def plain_hits(text, items, width=13):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hit, names = set(), set()
    for name, item in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in item or ""))
        n = min(width, len(own))
        wanted = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in wanted:
                hit.update(range(i, i + n))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def test_contamination(spark, odd, empty):
    rng = np.random.default_rng(3)
    words = list("abcde")
    items = [(i, " ".join(rng.choice(words, int(rng.integers(1, 30))))) for i in range(20)]
    items += [(20, None), (21, ""), (None, "a b"), (22, "Ä-ö É"), (22, "Ä-ö É"), (23, items[3][1])]
    texts = [(i, " ".join(rng.choice(words, int(rng.integers(0, 80))))) for i in range(60)]
    texts += [(100, f"x {items[5][1].upper()}, y"), (101, "zz ä Ä ö É zz"), (102, None), (103, "")]
    benchmark = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, n_hit int")
    known = [x for x in items if x[0] is not None]
    for most in (1 << 20, 100):  # one automaton, several
        got = {r["doc_id"]: r for r in decontaminate.contamination(frame(spark, texts), benchmark, automaton_bytes=most).collect()}
        for i, text in texts:
            n, hit, names = plain_hits(text, known)
            r = got[i]
            assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, names)
            assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
            found = sum(len(decontaminate.words_of(text[s["start"] : s["stop"]])) for s in r["spans"])
            assert found == hit
    assert decontaminate.contamination(odd, benchmark).count() == len(ODD)
    assert decontaminate.contamination(odd, benchmark.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(empty, benchmark).count() == 0


def test_matcher_finds_nested_and_overlapping_blocks():
    rng = np.random.default_rng(5)
    for letters, most in (("ab", 16), ("abc", 40)):
        items = [(str(i), " ".join(rng.choice(list(letters), int(rng.integers(0, most))))) for i in range(60)]
        matcher = decontaminate.Matcher(items)
        for _ in range(60):
            text = " ".join(rng.choice([*letters, "zz"], int(rng.integers(0, 120)), p=[0.9 / len(letters)] * len(letters) + [0.1]))
            n, hits, names = matcher.scan(text)
            assert (n, decontaminate.covered(hits), names) == plain_hits(text, items)


def test_a_large_benchmark_is_one_scan(spark):
    words = [f"w{i}" for i in range(5000)]
    rng = np.random.default_rng(6)
    items = [(i, " ".join(rng.choice(words, 200))) for i in range(4000)]  # above the 2 MB of earlier automata
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(frame(spark, [(1, items[3999][1]), (2, "w1 " * 50)]), benchmark)
    assert "Join" not in found._jdf.queryExecution().toString()
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in found.collect()}
    assert got == {1: (200, ["3999"]), 2: (0, [])}


# near copies


def plain_groups(rows, words, percent):
    sets = {}
    for i, text in rows:
        split = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        n = min(words, len(split))
        sets[i] = {tuple(split[k : k + n]) for k in range(len(split) - n + 1)} if n else set()
    label = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {i: new if x == old else x for i, x in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard_groups(spark, monkeypatch, words, percent):
    rng = np.random.default_rng(words)
    pool = ["".join(rng.choice(list("abcdefghij"), 3)) for _ in range(400)]
    line = " ".join(rng.choice(pool, 12))
    texts = []
    for _ in range(40):
        base = [*rng.choice(pool, int(rng.integers(3, 120)))]
        if rng.random() < 0.6:
            base = [*line.split(), *base]
        for _ in range(int(rng.integers(1, 6))):
            near = list(base)
            for _ in range(int(rng.integers(0, 4))):
                near[int(rng.integers(len(near)))] = str(rng.choice(pool))
            texts.append(" ".join(near))
    texts += ["", None, "a", "A", "a b", "a  B", "\x1c", *texts[:5]]
    rows = list(enumerate(texts))
    monkeypatch.setattr(jaccard, "MOST_COMMON", 40)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 4)
    monkeypatch.setattr(jaccard, "COLUMNS", 64)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(frame(spark, rows), words, percent).collect()}
    assert got == plain_groups(rows, words, percent)


def test_jaccard_of_odd_rows(spark, odd, empty):
    got = jaccard.jaccard_groups(odd).collect()
    assert len(got) == len(ODD) and all(r["component_id"] == r["doc_id"] for r in got)
    assert jaccard.jaccard_groups(empty).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in jaccard.components(chain).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, FOLDER)
        if name != "packing":
            assert after.columns == docs.columns
        if name == "near_copies":
            kept = {r["doc_id"] for r in after.collect()}
            groups = plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
            assert kept == {i for i, (_, label) in groups.items() if i == label}
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            for r in docs.collect():
                n, hit, _ = plain_hits(r["text"], items)
                assert (r["doc_id"] in {x["doc_id"] for x in after.select("doc_id").collect()}) == (not (hit and 20 * hit >= n))
        if name == "personal_data":
            assert after.count() == docs.count()
        docs = after


def test_pipeline_of_odd_rows(spark, odd):
    docs = odd.drop("score", "n")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert name == "packing" or docs.count() >= len(ODD) - 1


def test_stages_keep_clashing_columns(spark):
    names = ["base", "spans", "added", "key", "score", "predicted", "items", "contaminated"]
    docs = spark.createDataFrame([(1, "plain words and 1.2.3.4 here"), (2, None)], "doc_id long, text string")
    docs = docs.withColumns({n: F.lit(f"own {n}") for n in names})
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_contaminated, corpus_pipeline.redact_personal_data):
        got = stage(spark, docs, FOLDER)
        assert got.columns == docs.columns
        rows = got.collect()
        assert len(rows) == 2 and all(r[n] == f"own {n}" for r in rows for n in names)
