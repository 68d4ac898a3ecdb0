"""SimHash groups, ranked search and the filter audit against plain Python, on small frames with awkward rows."""

import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallycrest.llm import filter_audit, jaccard, simhash, topk, treap, urls
from tallycrest.llm import queries as corpus
from tallycrest.llm.common import join_groups

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

ODD = [(None, "no id"), (None, None), (1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "a"), (4, "b a"), (5, "é 😀 İ"),
       (6, "x" * 200_000), (7, "7 7 " * 30_000), (8, "A B c"), (9, "a b C")]


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def frame(spark, texts, langs=("en",)):
    rows = [(i, t, langs[k % len(langs)], "s", len(t or "")) for k, (i, t) in enumerate(texts)]
    clash = {c: F.lit("clash") for c in ("point", "component", "copies", "n", "key", "flags", "digest", "score", "rank")}
    return spark.createDataFrame(rows, DOCS).withColumns(clash)


def docs_of(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


# simhash


def plain_print(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    n = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)] if n else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(points, limit):
    """Smallest row of each row's group, all pairs compared."""
    root = list(range(len(points)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(points)), 2):
        if (points[a] ^ points[b]).bit_count() <= limit:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return [top(x) for x in range(len(points))]


def assert_groups(spark, rows, got, size=4, limit=4):
    points = [plain_print(t, size) for _, t in rows]
    roots = plain_groups(points, limit)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = sorted(((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, points, roots, strict=True)), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()), key=repr) == want


@pytest.mark.parametrize("size,limit,stretches,part", [(4, 4, 6, 4096), (4, 4, 5, 7), (1, 6, 8, 4096), (3, 0, 1, 50)])
def test_simhash_groups(spark, monkeypatch, size, limit, stretches, part):
    monkeypatch.setattr(simhash, "PART", part)
    rows = docs_of(spark)
    # near copies by one changed word, so that groups chain
    base = "one two three four five six seven eight nine ten eleven twelve " * 8
    rows += [(1000 + i, base.replace("nine", f"w{i}", 1 + i % 3)) for i in range(60)]
    got = simhash.simhash_groups(frame(spark, rows), size, limit, stretches)
    assert_groups(spark, rows, got, size, limit)


def test_simhash_of_odd_rows(spark):
    got = simhash.simhash_groups(frame(spark, ODD))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert_groups(spark, ODD, got)
    assert simhash.simhash_groups(frame(spark, ODD).limit(0)).collect() == []


def test_simhash_in_few_rows_at_a_time(spark, monkeypatch):
    """Units that end within and across what a worker holds; large keys sent by a shuffle instead."""
    monkeypatch.setattr(simhash, "WORKER_ROWS", 64)
    monkeypatch.setattr(simhash, "PART", 16)
    monkeypatch.setattr(simhash, "MOST_SENT", 0)
    rng = np.random.default_rng(3)
    centers = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    points = {int(c) ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)) for c in centers for _ in range(30)}
    data = sorted(points)
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in data]
    found = simhash.near_pairs(spark.createDataFrame(signed, "point long")).collect()
    links = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in found]
    place = {p: i for i, p in enumerate(data)}
    root = np.arange(len(data))
    root = simhash._merged(root, *(np.array([place[x[k]] for x in links]) for k in (0, 1)))
    assert root.tolist() == plain_groups(data, 4)


def test_pivot_coordinates_tell_stretches_apart():
    """Coordinates on a stretch are equal for equal bits only, and near points keep within the limit on all references."""
    rng = np.random.default_rng(5)
    for stretches in (1, 5, 6, 8):
        masks = simhash.stretch_masks(stretches)
        assert sum(int(m).bit_count() for m in masks) == 64 and int(np.bitwise_or.reduce(masks)) == (1 << 64) - 1
        points = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        table = simhash.pivot_table(points, masks)
        assert (table.sum(axis=1) == simhash.pivot_table(points)).all()
        if stretches > 4:  # the references have full rank on stretches of up to 16 bits
            for i, mask in enumerate(masks):
                rows = {tuple(r) for r in table[:, i]}
                assert len(rows) == len({int(p & mask) for p in points})


# hot groups


def test_join_groups_keeps_all_rows_of_hot_and_cold_groups(spark):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    got = join_groups(rows, groups, "k").collect()
    assert sorted(r["id"] for r in got) == list(range(5000))
    assert all(r["least"] == (0 if r["id"] % 3 == 0 else r["id"]) for r in got)


# ranked search


def plain_terms(text):
    return Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text or "")))


def plain_search(docs, items, count):
    docs = [(i, plain_terms(t)) for i, t in docs if i is not None]
    n = sum(bool(c) for _, c in docs)
    total = sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, words in asked.items():
        scored = []
        for i, c in docs:
            m = 100 - 90 + 90 * c.total() * n // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in words if t in c
            )
            scored += [(-score, i)] if score > 0 else []
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:count], 1)]
    return sorted(out)


def searched(df):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("shard,at_once", [(1 << 14, 256), (7, 1)])
def test_search_equals_plain_scores(spark, monkeypatch, shard, at_once):
    monkeypatch.setattr(treap, "SHARD_DOCS", shard)
    monkeypatch.setattr(treap, "AT_ONCE", at_once)
    docs = docs_of(spark)[:120] + [x for x in ODD if x[0] is None or x[0] != 6]
    docs += [(500 + i, "tie break " * (1 + i % 2)) for i in range(30)]
    items = [(i, docs[i][1]) for i in range(6)] + [(7, "tie, BREAK"), (7, "é"), (8, None), (9, "?!"), (None, "a"), (10, "zzzz9")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    assert searched(treap.search(frame(spark, docs), asked, 10)) == plain_search(docs, items, 10)


def test_search_of_nothing(spark):
    docs = frame(spark, ODD)
    items = spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert treap.search(docs.limit(0), items).collect() == []
    assert treap.search(docs, items.limit(0)).collect() == []
    assert dict(treap.search(docs, items).dtypes)["item_id"] == "int"


def test_treap_is_best_first_and_exact():
    rng = np.random.default_rng(1)
    for rows, columns, filled in ((1, 1, 1), (40, 900, 3000), (900, 40, 3000), (300, 300, 20)):
        cells = np.unique(rng.integers(0, rows * columns, filled))
        row, column = cells // columns, cells % columns
        value = rng.integers(1, 50, len(cells))  # many ties
        dense = np.zeros((rows, columns), np.int64)
        dense[row, column] = value
        tree = treap.Treap(row, column, value)
        for _ in range(20):
            path = rng.choice(rows, min(rows, 9), replace=False)
            total = dense[path].sum(axis=0)
            order = np.lexsort((np.arange(columns), -total))
            want = [(int(total[c]), int(c)) for c in order if total[c] > 0][:10]
            assert tree.best(path, 10, 0) == want
            assert tree.best(path, 10, 12) == [x for x in want if x[0] > 12]
    assert treap.Treap(*(np.zeros(0, np.int64) for _ in range(3))).best(np.array([0]), 10, 0) == []


def test_long_documents_do_not_overflow():
    known = treap.Statistics(10**11, 10**13, np.array([5]))
    assert known.length_factor([10**9])[0] == 10 + 90 * 10**9 * 10**11 // 10**13


# filter audit


def plain_audit(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    rows = []
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > first[t],
        }
        good = i is not None and any(x[0] == i and x[1] == 1 for x in labels)
        toxic = i is not None and any(x[0] == i and x[2] == 1 for x in labels)
        rows.append((lang or "", fails, good, toxic))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        share, found = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                share[f] += len(gone)
                redundant = sum(r[1][f] for r in mine) - len(gone)
                unique = sum(r[1][f] and sum(r[1].values()) == 1 for r in mine)
                lost = sum(r[2] for r in gone), sum(r[3] for r in gone)
                found.append(("".join(order), step, len(left), len(gone), redundant, unique, *lost))
        out += [(part, *x, share[x[0][x[1] - 1]]) for x in found]
    return sorted(out)


def test_audit_equals_plain_counts(spark):
    rng = np.random.default_rng(2)
    texts = ["# " + "w " * 150, "A B C", " ".join(map(str, range(200))), " ".join(map(str, range(200))) + " |", "", None,
             "Ünder 100 ÄÖ", " ".join(f"W{i}X" for i in range(120))]
    docs = [(int(i), texts[int(rng.integers(len(texts)))], ("en", None, "", "de")[int(rng.integers(4))]) for i in rng.integers(0, 60, 150)]
    docs += [(None, texts[2], "en"), (None, texts[2], "en"), (0, "é  é", "xx"), (7, "z" * 100_000, "xx")]
    labels = [(int(i), (0, 1, None)[int(rng.integers(3))], (0, 1, None)[int(rng.integers(3))]) for i in rng.integers(0, 60, 40)] + [(None, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns(
        {c: F.lit("clash") for c in ("part", "flags", "digest", "n", "good", "first")}
    )
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("clash"))
    got = filter_audit.audit(frame, marks)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(docs, labels)
    nothing = filter_audit.audit(frame, marks.limit(0)).agg(F.sum("good_lost"), F.count(F.lit(1))).first()
    assert tuple(nothing) == (0, 4 * 600)
    assert filter_audit.audit(frame.limit(0), marks).collect() == []


def test_new_queries_are_registered():
    assert {"op11_simhash", "op12_search", "op13_filter_audit"} <= corpus.QUERIES.keys()


# near copies under repeated ids


def test_two_texts_under_one_id_keep_their_links(spark):
    """Row (5, A) is a copy of row 1; the other text of id 5 still links to 9."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (5, a), (5, b), (9, b + " more")]
    got = jaccard.jaccard_rows(frame(spark, rows), 3, 90).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (5, 1), (5, 5), (9, 5)]
    assert sorted(r["doc_id"] for r in got if r["keep"]) == [1, 5]
    kept = jaccard.drop_near_copies(frame(spark, rows), 3, 90).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, a), (5, b)]


@pytest.mark.parametrize("most", [500_000, 0])
def test_repeated_rows_are_one_class(spark, monkeypatch, most):
    """20,000 copies under one id and some near copies: products see one row of each text."""
    monkeypatch.setattr(jaccard, "MOST_SENT", most)  # 0: ids are joined by a shuffle instead of sent
    base = [f"w{i}" for i in range(50)]
    near = [" ".join([*base[:-1], f"x{i}"]) for i in range(3)]
    rows = [(7, " ".join(base))] * 20_000 + [(8 + i, t) for i, t in enumerate(near)] + [(20, None), (20, None), (21, "other")]
    found = jaccard.jaccard_groups(frame(spark, rows), 3, 80).groupBy("doc_id", "n_shingles", "component_id").count().collect()
    want = [(7, 48, 7, 20_000), (8, 48, 7, 1), (9, 48, 7, 1), (10, 48, 7, 1), (20, 0, 20, 2), (21, 1, 21, 1)]
    assert sorted(tuple(r) for r in found) == want
    kept = jaccard.drop_near_copies(frame(spark, rows), 3, 80)
    assert kept.columns == frame(spark, rows).columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(7, " ".join(base)), (20, None), (20, None), (21, "other")]


def test_a_place_of_many_sizes_and_one_hot_size(spark, monkeypatch):
    """Blocks from counts by size: all classes of a place are placed, near-equal ones in few blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 10)
    met = spark.createDataFrame([(0, i, 100) for i in range(95)] + [(0, 1000 + i, 101 + i) for i in range(20)] + [(0, 5000, 900)],
                                "place long, node long, n long")
    got = jaccard._blocks(met, 90).collect()
    assert {r["node"] for r in got} == {r["node"] for r in met.collect()} - {5000}  # too far in size from all
    sizes = {}
    for r in got:
        sizes.setdefault(r["block"], []).append(r["n"])
    assert max(map(len, sizes.values())) <= 30 and len(sizes) >= 10


# exact scores of large components


def test_top_k_of_large_components_is_exact(spark):
    """Integers beyond 64 bits on the way decide order and ties; only a result that does not fit a long is an error."""
    big = 2.0**21
    vectors = [(50, [big]), (1, [big]), (2, [2 * big]), (3, [-1.0]), (4, [1e30, 1.0]), (100, [0.0, 2.0**-8]), (5, [0.0, 2.0**52 + 0.5])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    usable = topk.integer_vectors(df)
    exact = {i: [math.floor(256 * x) for x in v] for i, v in vectors}
    assert {r["id"]: [int(x) for x in r["v"]] for r in usable.collect()} == exact
    fitting = usable.filter("id <> 4")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(fitting.filter("id % 50 = 0"), fitting, 5).collect()]
    want = []
    for q in (50, 100):
        scores = sorted((-sum(a * b for a, b in zip(exact[q], v, strict=False)), i) for i, v in exact.items() if i not in (q, 4))
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:5], 1)]
    assert sorted(got) == want and (50, 1, 2, 2**59) in got and (50, 2, 1, 2**58) in got
    # vector 4 takes part where its scores fit, and is an error where one that does not is among the best
    other = topk.top_k(usable.filter("id = 100"), usable, 5).filter("vec_id = 4").collect()
    assert [r["score"] for r in other] == [256]
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(usable.filter("id = 50"), usable, 5).collect()


def test_top_k_of_many_dimensions_does_not_overflow():
    rng = np.random.default_rng(6)
    rows = rng.integers(-(1 << 31), 1 << 31, (300, 512)).astype(np.float64)
    assert topk.largest_sum(rows, rows) >= topk.SAFE
    whole = topk.whole_numbers(rows, True)
    shard = topk.Shard(np.arange(300), whole)
    for q in (0, 7):
        want = sorted((-sum(a * b for a, b in zip(whole[q], r, strict=True)), i) for i, r in enumerate(whole) if i != q)[:5]
        at, score = shard.search(q, whole[q], 5, None)
        assert [(-s, i) for i, s in zip(at.tolist(), score, strict=True)] == want


# URLs


def test_hot_labelled_urls_train_with_the_others(spark):
    """Two URLs of many copies are two rows of the sample, whatever its size."""
    rows = ["http://a.com/x"] * 30 + ["http://b.net/es/1"] * 30 + ["http://c.org/es/2", "http://d.org/x"]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    for sample in (1, 50_000):
        got = urls.judge(df, sample=sample).collect()
        assert len(got) == 62 and {r["verdict"] for r in got} <= {"allow", "block"}
    mixed = rows + [f"http://n{i}.net/es/{i}" for i in range(40)] + [f"http://n{i}.com/about-{i}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(mixed)), "page_id long, url string")
    got = {r["url"]: r["verdict"] for r in urls.judge(df, sample=20).collect()}
    assert got["http://a.com/x"] == "allow" and got["http://b.net/es/1"] == "block"
    assert got["http://c.org/es/2"] == "block"


def test_lexical_features_equal_plain_ones(spark):
    given = ["http://a.com/x/y?a=1&b=2", "h://B.Net/es/", "http://x9.org", "http://é.net/ü/%20?q=1#f", "://com//", None, "7://1.2.3.4/5"]
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    parsed = urls.match_rules(urls.parts(df), urls.RULES)
    stats = urls.suffix_statistics(parsed.select("host", "listed"))
    for r in urls.features(parsed, stats).collect():
        url = r["url"] or ""
        size = max(1, len(url))
        assert r["url_length"] == size and r["host_length"] == len(r["host"]) and r["path_length"] == len(r["path"])
        assert r["host_depth"] == r["host"].count(".") and r["path_depth"] == r["path"].count("/")
        assert r["digit_ratio"] == pytest.approx(len(re.findall("[0-9]", url)) / size)
        assert r["hyphens"] == r["host"].count("-")
        counts = Counter(url)
        entropy = -sum(n / len(url) * math.log2(n / len(url)) for n in counts.values())
        assert r["entropy"] == pytest.approx(entropy, abs=1e-9)
