"""Nearest neighbours, URL filters, near copies and the pipeline's stages against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomlake.llm import ann, simhash, url_filter


def neighbours(rows, queries, k=10):
    good = {i: v for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 64}
    out = set()
    for q in (i for i in good if i in queries):
        near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, good[q], strict=True))), i) for i, v in good.items() if i != q)
        out |= {(q, n + 1, i) for n, (_, i) in enumerate(near[:k])}
    return out


@pytest.fixture
def vectors():
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(64) + (i % 3)]) for i in range(600)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)]  # ties
    return rows + [(2000, None), (2001, [0.0] * 64), (2002, [float("nan")] + [1.0] * 63), (2003, []), (2004, [1.0, 2.0]), (2005, [None] + [1.0] * 63)]


def test_search_equals_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id bigint, embedding array<float>, centroid int").repartition(5)
    index, book = ann.build_index(df)
    got = {(r.query_id, r.rank, r.vec_id) for r in ann.search(index, book, F.col("vec_id") % 100 == 0).collect()}
    want = neighbours(vectors, {i for i, _ in vectors if i % 100 == 0})
    assert len(got & want) / len(want) >= 0.99 and len(got) == len(want)
    exact = {(r.query_id, r.rank, r.vec_id) for r in ann.search(index, book, F.col("vec_id") % 100 == 0, deviations=math.inf).collect()}
    assert exact == want


def test_inner_products_of_packed_bits(vectors):
    x = np.array([v for i, v in vectors if i < 300])
    book = ann.Codebook(x)
    _, code, _, _ = book.encode(x)
    signs = np.unpackbits(code, axis=1, count=64).astype(float) * 2 - 1
    packed = ann.PackedQueries(x[:20], book)
    off = np.abs(packed.signs_product(ann._words(code)) - signs @ (x[:20] @ book.rotation).T)
    assert (off <= packed.slack + 1e-9).all()


def test_search_of_few_and_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    index, book = ann.build_index(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], schema))
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(index, book, F.col("vec_id") == 0).collect()] == [(0, 1, 1, math.sqrt(2))]
    index, book = ann.build_index(spark.createDataFrame([], schema))
    assert ann.search(index, book, F.col("vec_id") == 0).collect() == []


def judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls(spark):
    rng = random.Random(1)
    hosts = ["a.example.com", "EXAMPLE.com", "com", "x.y.example.net", "notexample.com", "net", "org", "www.org", "a..com", "", "é.com", "1.2.3.4:80"]
    paths = ["/en/", "/en/7", "/en/78/x", "/de/8", "/de/", "/es", "/es/", "", "/en", "?q=/en/", "#/en/", "/en/7?x#y", "/EN/7"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme.com/en/", "http:/x.com/en/", "://com/en/", "http://a.com/en/\nx", "http://b.com/x://net/de/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, urls[0])] * 2 + [(0, urls[0])]
    rng.shuffle(rows)
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in rows], "page_id bigint, url string, html string, rule string")
    got = sorted((tuple(r) for r in url_filter.filter_urls(pages, url_filter.rule_table(spark, url_filter.CONTRACT_RULES)).collect()), key=str)
    assert got == sorted(((i, *judge(u, url_filter.CONTRACT_RULES)) for i, u in rows), key=str)
    none = url_filter.filter_urls(pages, url_filter.rule_table(spark, [("x.com", "/", "other")]))
    assert {r.verdict for r in none.collect()} == {"allow"} and none.count() == len(rows)
    assert url_filter.filter_urls(pages.limit(0), url_filter.rule_table(spark, url_filter.CONTRACT_RULES)).collect() == []
    both = url_filter.rule_table(spark, [("com", "/en/", "allow"), ("com", "/en/", "block")])
    assert {r.verdict for r in url_filter.filter_urls(pages, both).where("rule = 'com/en/'").collect()} == {"block"}


def copies(seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(3000)]
    base = [rng.choices(words, k=rng.randint(60, 300)) for _ in range(120)]
    rows, family = [(i, " ".join(b)) for i, b in enumerate(base)], {i: i for i in range(120)}
    for i in range(40):
        for n in range(3):
            copy = list(base[i])
            for _ in range(max(1, len(copy) // 120)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((1000 + 10 * i + n, " ".join(copy)))
            family[1000 + 10 * i + n] = i
    return rows, family


def test_near_copies_are_found_and_others_left_alone(spark):
    rows, family = copies()
    docs = spark.createDataFrame([(i, t, "b", 1) for i, t in rows], "doc_id bigint, text string, bits string, node int")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    assert len(got) == len(rows) and sum(got[i] == family[i] for i in family) >= len(family) - 3


def jaccard(a, b, k=5):
    a, b = ({tuple(t[i : i + k]) for i in range(len(t) - k + 1)} for t in (a.split(), b.split()))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("nearest", [1, 8])
def test_links_are_exactly_of_the_similarity(spark, monkeypatch, nearest):
    monkeypatch.setattr(simhash, "NEAREST", nearest)
    rng, rows, want = random.Random(9), [], {}
    for i in range(60):  # pairs of similarity 0.65 to 0.95
        base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        other = list(base)
        for at in range(0, 5 + i % 8):
            other[20 * at + 10] = "new"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
        want |= {2 * i: 2 * i, 2 * i + 1: 2 * i if jaccard(*[t for _, t in rows[-2:]]) >= 0.8 else 2 * i + 1}
    # one repeated shingle outweighs all others, which differ
    rows += [(k, "again " * 500 + " ".join(f"v{rng.randrange(10**6)}" for _ in range(100))) for k in (1000, 1001)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    assert not [i for i in want if want[i] == i != got[i]] and (got[1000], got[1001]) == (1000, 1001)
    linked = [i for i in want if want[i] != i]
    assert 10 < len(linked) < 50 and sum(got[i] == want[i] for i in linked) >= 0.9 * len(linked)


@pytest.mark.parametrize("most", [1 << 17, 32])
def test_large_groups_lose_no_links(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "BLOCK_TEXTS", most)
    monkeypatch.setattr(simhash, "SUBTREE_MOST", most)
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    # each text is alike only to the next ones of the chain: 0.90, 0.81, 0.73
    rows = [(i, " ".join(words[15 * i : 15 * i + 300])) for i in range(110)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.component_id for r in simhash.near_copies(docs).collect()} == {0}


def test_many_near_copies_of_one_text(spark):
    """5,000 texts of one template: their groups by exact similarity are found, and nothing else joins."""
    rng, words = random.Random(11), [f"w{i}" for i in range(5000)]
    base, rows = rng.choices(words, k=120), []
    for i in range(5000):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 8])):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)).collect()}
    sets = {i: set(simhash._shingle_hashes(t, 5).tolist()) for i, t in rows}
    core = {i for i, s in sets.items() if len(s & sets[0]) / len(s | sets[0]) >= 0.8}
    root = max(set(got.values()), key=list(got.values()).count)
    inside = [i for i in got if got[i] == root]
    assert len(got) == 5000 and len(inside) > 2500
    # texts outside have no partner inside, but for the share that bits miss
    outside, some = [i for i in got if got[i] != root], rng.sample(inside, 400)
    missed = [i for i in outside if any(len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8 for j in some)]
    assert len(missed) <= 0.02 * len(inside) and core


def test_one_of_each_keeps_one_row_of_each_group(spark):
    rows, family = copies()
    rows += [(0, rows[0][1]), (500, rows[0][1]), (None, rows[7][1]), (None, None), (None, None), (600, ""), (7, "another text under an id that is taken " * 9)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, _key int")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(0) == 1 and 500 not in ids and ids.count(7) == 2 and ids.count(600) == 1 and None not in ids
    assert set(range(120)) <= set(ids) and sum(i >= 1000 for i in ids) <= 3
    assert simhash.one_of_each(docs.limit(0)).collect() == []


def test_pipeline_stages(spark, tmp_path):
    rows, _ = copies()
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t)) for i, t in rows] + [(3000, None, None, None, None), (3001, "12 34", "en", "s1", 5)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"file:{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"file:{tmp_path}/documents.parquet")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, f"file:{tmp_path}")
        if k < 3:
            assert after.columns == names
            assert after.join(docs, ["doc_id", "text"], "left_anti").isEmpty(), name
            docs = after
    assert {3000, 3001}.isdisjoint(r.doc_id for r in docs.collect())
    assert after.where("not same").isEmpty() and after.count() == docs.count() > 0
    assert corpus_pipeline.run(spark, f"file:{tmp_path}").count() == docs.count()
