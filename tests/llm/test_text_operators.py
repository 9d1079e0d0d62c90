"""Token counts, language ID, MinHash, language model, BPE, against brute force on small fixtures."""

import hashlib
import math
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from loomlake.llm import bpe, hilbert, langid, language_model, minhash, mixing, simhash, token_counts

RANKS = P.path("byte_bpe_50k.tiktoken")
EDGE = ["", None, "a", " ", "\n\n", "naïve café 漢字🙂 x", "don't  stop\t\tnow\r\n", "1234567 ab12", "\x00\x1f ", "a" * 3000, "ab " * 20_000]


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def frame(spark, texts, schema="doc_id bigint, text string, lang string, source string, n_chars string, ids string, uid string"):
    return spark.createDataFrame([(i, t, "x", None, "clash", None, "u") for i, t in enumerate(texts)], schema)


def texts(n=300, seed=1):
    rng = random.Random(seed)
    words = [["the", "and", "of", "ing", "er", "tion", "wh"], ["der", "und", "ei", "sch", "ung", "ver", "ö"]]
    out = []
    for i in range(n):
        w = words[i % 2]
        out.append(" ".join("".join(rng.choices(w, k=rng.randint(1, 3))) for _ in range(rng.randint(5, 80))) + ".")
    return out


def test_transducer_equals_tiktoken(tik):
    own, rng = bpe.Codec(RANKS, P.PATTERN), random.Random(0)
    tokens = list(own.machine.ranks)
    cases = [t or "" for t in EDGE] + texts(50) + [b"".join(rng.choices(tokens, k=rng.randint(1, 6))).decode("utf-8", "replace") for _ in range(3000)]
    for text in cases:
        ids, numbers = own.encode(text)
        assert ids.tolist() == tik.encode_ordinary(text), text[:50]
        assert numbers == " ".join(map(str, ids))
        assert "".join(x for _, x in own.decode(ids)) == text


def test_transducer_states_take_little_memory():
    own, rng = bpe.Codec(RANKS, P.PATTERN).machine, random.Random(1)
    words = [bytes(rng.choices(b"etaoinshrdlu", k=12)) for _ in range(3000)]
    for w in words:
        own.encode(w)
    own._reset()  # the compatible pairs stay
    tracemalloc.start()
    for w in words:
        own.encode(w)
    taken = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(own.paths) > 5000 and taken / len(own.paths) < 480


def test_worker_remembers_for_one_operator_only():
    bpe.codec(RANKS, P.PATTERN)
    mixing.profile("some words")
    assert not bpe._CODECS and mixing._MEMO
    simhash.fingerprint("some words")
    assert not mixing._MEMO
    kept = bpe.codec(RANKS, P.PATTERN)
    assert bpe.codec(RANKS, P.PATTERN) is kept
    langid.trigram_counts("some words")
    assert not bpe._CODECS


def test_transducer_is_the_same_when_tables_overflow(tik, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_PIECES", 5)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 20)
    own = bpe.Codec(RANKS, P.PATTERN)
    for text in texts(40):
        assert own.encode(text)[0].tolist() == tik.encode_ordinary(text)


def test_utf8_state_machine_at_any_cut():
    data = "aé漢🙂z".encode()
    for cut in range(len(data) + 1):
        s = bpe.Utf8Stream()
        assert s.push(data[:cut]) + s.push(data[cut:], True) == data.decode()


def test_round_trip_query(spark, tik):
    docs = frame(spark, EDGE)
    got = {r.doc_id: r for r in bpe.round_trip(docs, RANKS, P.PATTERN).collect()}
    for i, t in enumerate(EDGE):
        ids = tik.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    encoded = bpe.encode_documents(docs, RANKS, P.PATTERN)
    assert {r.doc_id: r.text for r in bpe.decode_documents(encoded, RANKS, P.PATTERN).collect()} == {i: t or "" for i, t in enumerate(EDGE)}
    assert bpe.round_trip(docs.limit(0), RANKS, P.PATTERN).collect() == []


def brute_sections(tik, text, spans):
    tokens, at = [], 0
    data = text.encode()
    char = [len(data[:i].decode("utf-8", "ignore")) for i in range(len(data) + 1)]
    for token in tik.encode_ordinary(text):
        n = len(tik.decode_single_token_bytes(token))
        start, end = char[at], char[at + n]
        if len(data[: at].decode("utf-8", "ignore").encode()) < at:  # begins inside a character
            start = char[at]
        end = max(end, start + 1) if len(data[: at + n].decode("utf-8", "ignore").encode()) < at + n and end == start else end
        if len(data[: at + n].decode("utf-8", "ignore").encode()) < at + n:
            end = char[at + n] + 1
        tokens.append((start, end))
        at += n
    most = [0] * len(spans)
    for s, e in tokens:
        over = [max(0, min(e, b) - max(s, a)) for a, b in spans]
        if max(over, default=0) and max(over) >= (e - s) - sum(over):
            most[over.index(max(over))] += 1
    return most


@pytest.mark.parametrize("text", [t or "" for t in EDGE[:9]] + ["one\n\n\ntwo words\n  \nthree", "é\né漢\n🙂"])
def test_lines_add_up(spark, tik, text):
    rows = sorted(token_counts.section_tokens(frame(spark, [text]), RANKS, P.PATTERN).collect(), key=lambda r: r.section)
    assert sum(r.n_tokens for r in rows) == len(tik.encode_ordinary(text)) == rows[0].doc_tokens
    assert math.isclose(sum(r.token_share for r in rows), rows[0].doc_tokens, abs_tol=1e-9)
    assert [r.n_tokens for r in rows] == brute_sections(tik, text, [(r.start_char, r.end_char) for r in rows])
    assert rows[0].start_char == 0 and rows[-1].end_char == len(text)


def test_given_sections(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma", [("a", 0, 8), ("b", 8, 99)]), (2, "x", None), (3, None, [("a", 0, 4)])], "doc_id int, text string, parts array<struct<name: string, start: int, stop: int>>")
    most = {(r.doc_id, r.name): r for r in token_counts.section_tokens(docs, RANKS, P.PATTERN, "parts").collect()}
    start = {(r.doc_id, r.name): r.n_tokens for r in token_counts.section_tokens(docs, RANKS, P.PATTERN, "parts", "start").collect()}
    assert most[1, "a"].n_crossing == most[1, "b"].n_crossing == 1 and most[1, "b"].end_char == 16
    assert (most[1, "a"].n_tokens, most[1, "b"].n_tokens) == (2, 1) or sum(most[1, x].n_tokens for x in "ab") == most[1, "a"].doc_tokens
    assert start[1, "a"] >= most[1, "a"].n_tokens and (2, "a") not in most and most[3, "a"].n_tokens == 0


def test_language_is_learned_and_rejected(spark):
    rows = [(i, t, ["en", "de"][i % 2], "s") for i, t in enumerate(texts(400))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string")
    model = langid.fit(docs.where("doc_id < 300"))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert sum(got[i].lang_pred == rows[i][2] for i in range(300, 400)) >= 98 and not any(r.rejected for r in got.values())
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 ?! 34"), (4, "A."), (5, "qqqqzzzz " * 400)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[4].lang_pred in ("en", "de") and got[5].rejected
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.doc_id for r in langid.accepted(odd, model).collect()} <= {4}
    empty = langid.fit(docs.limit(0))
    assert langid.identify(odd, empty).first().lang_pred == "und"


def plain_trigrams(text):
    """Counts by bucket of the text's trigrams, in plain Python."""
    data = [b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in (" " + text.lower() + " ").encode()]
    out = Counter()
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        if b != 32 or (a != 32 and c != 32):
            out[(a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % (1 << 32) >> 19] += 1
    return out


def test_language_equals_plain_nearest_centroids(spark):
    some = texts(60)
    labelled = [(i, t, ["en", "de", "fr"][i % 3]) for i, t in enumerate(some)] + [(900, "uniek woord hier", "nl"), (901, None, "en"), (902, "1 2", "en"), (903, some[0], None)]
    model = langid.fit(spark.createDataFrame(labelled, "doc_id bigint, text string, lang string"), key=F.col("doc_id"))
    used = [(plain_trigrams(t), lang) for _, t, lang in labelled if t and lang and any(map(str.isalpha, t))]
    weight = [math.log((1 + len(used)) / (1 + sum(b in c for c, _ in used))) + 1 for b in range(langid.BUCKETS)]
    assert np.allclose(model.weights, weight) and model.languages == ["de", "en", "fr", "nl"] and set(model.owner) == {0, 1, 2, 3}

    def vector(counts):
        v = np.zeros(langid.BUCKETS)
        for b, n in counts.items():
            v[b] = math.log1p(n) * weight[b]
        return v / np.linalg.norm(v)

    # each centroid is the direction of the sum of its nearest texts of the language
    for k, lang in enumerate(model.languages):
        own, centroids = np.array([vector(c) for c, x in used if x == lang]), model.centroids[model.owner == k]
        at = (own @ centroids.T).argmax(1)
        for j in range(len(centroids)):
            mean = own[at == j].sum(0)
            assert mean @ centroids[j] / np.linalg.norm(mean) > 0.999
    asked = [*enumerate(texts(40, seed=5)), (100, "uniek woord"), (101, None), (102, ""), (None, "een woord"), (103, some[1])]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(asked, "doc_id bigint, text string"), model).collect()}
    for i, t in asked:
        if not t:
            assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
            continue
        counts = plain_trigrams(t)
        cosines = model.centroids @ vector(counts)
        size = min(31, sum(counts.values()).bit_length())
        assert got[i].lang_pred == model.languages[model.owner[cosines.argmax()]] and math.isclose(got[i].score, cosines.max(), abs_tol=1e-5)
        assert got[i].rejected == (1 - cosines.max() > model.mean[size] + langid.REJECT_DEVIATIONS * model.deviation[size])
    assert got[100].lang_pred == "nl"
    assert langid.identify(spark.createDataFrame([], "doc_id bigint, text string"), model).collect() == []


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_minhash_edits_and_estimates(spark):
    rows = [(i * 3 % 251, t) for i, t in enumerate(texts(120))] + [(1000, None), (1001, ""), (1002, "é漢🙂x"), (1003, texts(3)[0]), (1004, texts(3)[0])]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, edited string, fingerprint string")
    got = {r.doc_id: r for r in minhash.edited_likeness(docs).collect()}
    order, off = sorted(rows, key=lambda r: -r[0]), []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for near, other in ((got[i].near_edited, edited), (got[i].near_next, after)):
            a, b = shingles(t), shingles(other)
            off.append(near - len(a & b) / len(a | b))
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.12
    assert got[1003].fingerprint == got[1004].fingerprint and got[1004].near_next == 1.0
    one = minhash.edited_likeness(docs.where("doc_id = 1002")).collect()
    assert one[0].near_next == 1.0 and minhash.edited_likeness(docs.limit(0)).collect() == []


def test_next_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(minhash, "RANGE_ROWS", 3)
    ids = [*range(0, 60, 2), 10**12, -5, -(1 << 63), (1 << 63) - 1, None, None, None]
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id bigint, text string")
    order = sorted([i for i in ids if i is not None], reverse=True)
    got = [(r.doc_id, r.text, r.next_text) for r in minhash.with_next(df, ["text"]).collect()]
    assert sorted(t for _, t, _ in got) == sorted(f"t{k}" for k in range(len(ids)))
    after, of = {t: n for _, t, n in got}, {f"t{k}": i for k, i in enumerate(ids)}
    walk = [f"t{ids.index(order[0])}"]
    while len(walk) < len(ids):
        walk.append(after[walk[-1]])
    assert [of[t] for t in walk] == [*order, None, None, None] and after[walk[-1]] == walk[0]


def plain_fingerprint(text):
    """Bins, donors and packed bits in plain Python."""
    def signed(x):
        return x - (1 << 64) if x >> 63 else x
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    hashed = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    bins = {}
    for i in range(max(1, len(words) - 4)):
        h = 42
        for x in hashed[i : i + 5]:
            h = xxhash.xxh64_intdigest(struct.pack("<q", x), h)
        h = h >> 1 & ~1
        bins[h >> minhash.SHIFT] = min(h, bins.get(h >> minhash.SHIFT, h))
    out = []
    for i in range(minhash.BINS):
        donors = [i, *(minhash._draw(i, a) for a in range(minhash.DRAWS))]
        found = next((bins[d] for d in donors if d in bins), None)
        if found is None:
            found = min((signed(xxhash.xxh64_intdigest(struct.pack("<i", i), xxhash.xxh64_intdigest(struct.pack("<q", b), 42))), x) for b, x in bins.items())[1]
        out.append(f"{found >> 1 & 255:02x}")
    return "".join(out)


def test_fingerprints_equal_plain_ones(spark):
    some = [*texts(25), None, "", "one", "one two three four five six", "a " * 50, " ".join(f"w{i}" for i in range(3000))]
    rows = minhash.with_fingerprint(spark.createDataFrame([(i, t, "x") for i, t in enumerate(some)], "doc_id bigint, text string, fingerprint string")).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: plain_fingerprint(t) for i, t in enumerate(some)}


def test_language_model_base_and_gain(spark):
    rows = [*enumerate(texts(200)), (500, None), (501, ""), (502, "A\x0bb c"), (7, texts(200)[7])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, score string")
    tokens = [(i, (t or "").encode().lower().split() + [b" end "]) for i, t in rows]
    c = Counter(w for i, ws in tokens for w in ws if zlib.crc32(str(i).encode()) % 10)
    n, v = sum(c.values()), len(c)
    got = language_model.score_documents(docs).collect()
    want = sorted((i, len(ws), sum(w in c for w in ws)) for i, ws in tokens)
    assert sorted((r.doc_id, r.n_tokens, r.n_known) for r in got) == want and {r.train_tokens for r in got} == {n}
    base = {i: sum(math.log10((c.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in ws) for i, ws in tokens}
    assert all(math.isclose(r.base_score, base[r.doc_id], rel_tol=1e-9) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert language_model.score_documents(docs.limit(0)).collect() == []


def brute_scores(rows):
    """Deleted interpolation in plain Python: {id: log10 probability}."""
    words = {i: ["<e>", "<e>", *(t or "").lower().split(), "<e>"] for i, t in rows}
    c = [Counter() for _ in range(3)]
    before = [Counter() for _ in range(3)]
    train = [i for i in words if zlib.crc32(str(i).encode()) % 10]
    for i in train:
        w = words[i]
        for k in range(2, len(w)):
            for n in range(3):
                c[n][tuple(w[k - n : k + 1])] += 1
                before[n][tuple(w[k - n : k])] += 1
    n, v = sum(c[0].values()), len(c[0])

    def estimates(w, k, d):
        x, y = before[1][w[k - 1],], before[2][w[k - 2], w[k - 1]]
        own = [c[m][tuple(w[k - m : k + 1])] - d for m in range(3)]
        at = math.frexp(y - d)[1] if y - d > 0 else 64 + math.frexp(x - d)[1]
        return at, [(own[0] + 0.1) / (n - d + 0.1 * (v + 1)), own[1] / max(x - d, 1), own[2] / max(y - d, 1)]

    cells = {}
    for i in train:
        w = words[i]
        for k in range(2, len(w)):
            at, p = estimates(w, k, 1)
            steps = tuple(round(math.log2(x / p[0]) * language_model.STEPS) if x else None for x in p[1:])
            own = cells.setdefault((at, *steps), [0, 0.0, 0.0])
            own[0] += 1
            own[1] += p[1] / p[0]
            own[2] += p[2] / p[0]
    weights = {at: [1 / 3] * 3 for at, *_ in cells}
    for _ in range(language_model.ROUNDS):
        sums = {at: [0.0] * 3 for at in weights}
        for (at, *_), (m, r2, r3) in cells.items():
            part = [w * r for w, r in zip(weights[at], (1, r2 / m, r3 / m), strict=True)]
            for k in range(3):
                sums[at][k] += m * part[k] / sum(part)
        weights = {at: [x / sum(s) for x in s] for at, s in sums.items()}
    for at, w in weights.items():
        w[0] = max(w[0], 1e-6)
        weights[at] = [x / sum(w) for x in w]
    for at in range(128):
        if at in (0, 64):
            weights[at] = [1, 0, 0]
        weights.setdefault(at, weights.get(at - 1))
    out = {}
    for i, w in words.items():
        found = [estimates(w, k, 0) for k in range(2, len(w))]
        out[i] = sum(math.log10(sum(x * y for x, y in zip(weights[at], p, strict=True))) for at, p in found)
    return out


def test_language_model_scores_are_the_mixture(spark, monkeypatch):
    some = texts(150)
    rows = [*enumerate(some), (500, None), (501, ""), (502, " ".join(some[3].split()[:9])), (503, some[5]), (None, some[4])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute_scores([("" if i is None else i, t) for i, t in rows])
    for chunk, size in ((1_000_000, 4 << 20), (700, 500)):  # one chunk a task and one range, then many of each
        monkeypatch.setattr(language_model, "CHUNK", chunk)
        monkeypatch.setattr(language_model, "RANGE_BYTES", size)
        got = {"" if r.doc_id is None else r.doc_id: r.score for r in language_model.score_documents(docs).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-6) for k in got)
    named = spark.createDataFrame([(f"d{i}", t) for i, t in rows[:20]], "doc_id string, text string")
    assert {r.doc_id for r in language_model.score_documents(named).collect()} == {f"d{i}" for i in range(20)}


@pytest.mark.parametrize("n, bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_hilbert_steps_to_neighbours(n, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij")).reshape(n, -1)
    index = hilbert.hilbert_index(list(grid), bits)
    assert sorted(index) == list(range(len(index)))
    assert np.abs(np.diff(grid[:, np.argsort(index)], axis=1)).sum(0).max() == 1


def test_shards(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 5}") for i, t in enumerate(texts(205))] + [(None, None, None, None)] * 3 + [(1, "x", "en", "s1")] * 100
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id bigint, text string, lang string, source string, shard int")
    got = hilbert.shard_documents(docs).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(rows) and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    text = {i: t for i, t, *_ in rows}
    assert all(r.size == len((text[r.doc_id] or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) for r in got if r.doc_id not in (1, None))
    assert [r.hilbert for r in sorted(got, key=lambda r: (r.shard, r.slot))] == sorted(r.hilbert for r in got)
    assert hilbert.shard_documents(docs.limit(0)).collect() == []
    few = hilbert.shard_documents(docs.limit(3)).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0]


def test_texts_with_a_common_start_fill_all_cells(spark):
    rows = [(i, f"https://www.example.org/site{i % 200:05d}") for i in range(2000)] + [(5000 + i, "https://www.example.org/site00007") for i in range(900)] + [(9000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string").repartition(3)
    edges = hilbert.text_edges(docs, "source", 32, lambda x: x)
    assert len(edges) >= 20 and edges == sorted(set(edges))
    cells = {r.hilbert for r in hilbert.with_hilbert(docs, ["source"], 5).collect()}
    assert len(cells) >= 20 and hilbert.text_edges(docs.limit(0), "source", 32, lambda x: x) == []


def test_mixing_equals_plain_fitting(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices([f"{k}word{j}" for k in "ab"[i % 2] for j in range(30)], k=rng.randint(1, 40))), rng.choice(["en", "de", None]), rng.choice(["a"] * 6 + ["b", "c"])) for i in range(600)]
    rows += [(901, None, None, "z"), (902, "", "en", None), (rows[5][0], *rows[5][1:])]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, lang string, source string, _tokens int").repartition(3)
    targets = {"source": {"a": 1, "b": 1, "c": 2}, "lang": {"en": 1, "de": 1, "<null>": 0.5}, "topic": None}
    every = mixing.mix(docs, targets, budget=60.0).select("doc_id", "__topic").distinct().toPandas()
    topic = dict(zip(every["doc_id"], every["__topic"], strict=True))
    got = mixing.mix(docs, targets, budget=3.0).toPandas()
    assert set(got["_tokens"]) == {5} and len(set(topic.values())) > 1
    # plain fitting of the same cells
    cell, size = {i: (s or "<null>", lang or "<null>", topic.get(i)) for i, t, lang, s in rows}, {}
    n = {i: len((t or "").split()) for i, t, *_ in rows}
    for i, *_ in rows:
        size[cell[i]] = size.get(cell[i], 0) + n[i]
    assert all(topic.get(i) is not None for i in n if n[i] and cell[i][0] in "abc")
    def shares(m):
        own = {}
        for c, x in size.items():
            own[c[m]] = own.get(c[m], 0) + x
        given = [targets["source"], targets["lang"], None][m]
        weight = {k: ((given.get(k, 0.0) if given else x**0.5) if x else 0.0) for k, x in own.items()}
        return {k: w / sum(weight.values()) for k, w in weight.items()}
    share, goal = {c: float(x) for c, x in size.items()}, [shares(m) for m in range(3)]
    for _ in range(mixing.ROUNDS):
        for m in range(3):
            now = {}
            for c, x in share.items():
                now[c[m]] = now.get(c[m], 0.0) + x
            share = {c: x * goal[m][c[m]] / now[c[m]] if now[c[m]] else 0.0 for c, x in share.items()}
    k = 3.0 * sum(size.values()) / sum(share.values())
    want = {c: k * share[c] / size[c] if size[c] else 1.0 for c in size}
    draws = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i in n], "doc_id bigint").selectExpr("doc_id", f"pmod(xxhash64({mixing.SEED}, doc_id), {1 << 53}) / {float(1 << 53)}D").collect()}
    copies = Counter(got["doc_id"])
    for i, *_ in rows:
        times = sum(r[0] == i for r in rows)
        p = want[cell[i]] if cell[i] in want else 0.0
        if abs(draws[i] - p % 1) > 1e-3:
            assert copies[i] == times * (int(p) + (draws[i] < p % 1)), (i, p, draws[i])
    # the same by joins on the cluster
    monkeypatch.setattr(mixing, "LOCAL_CELLS", 0)
    cells = spark.createDataFrame([(*c, x) for c, x in size.items() if c[2]], "source string, lang string, topic string, tokens bigint")
    far = {tuple(r[:3]): r.share for r in mixing.rake(cells, targets, rounds=3).collect()}
    monkeypatch.setattr(mixing, "LOCAL_CELLS", 10**6)
    near = {tuple(r[:3]): r.share for r in mixing.rake(cells, targets, rounds=3).collect()}
    assert far.keys() == near.keys() and all(math.isclose(far[c], near[c], rel_tol=1e-9, abs_tol=1e-12) for c in far)
    assert mixing.mix(docs.limit(0)).collect() == []


def test_sample_meets_the_targets(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(1, 40), rng.choice(["en"] * 5 + ["de"]), rng.choice(["a"] * 18 + ["b", "c"])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = mixing.mix(docs, {"source": {"a": 1, "b": 1, "c": 2}, "lang": {"en": 1, "de": 1}, "topic": None}, budget=0.7)
    got = {(r.margin, r.value): r.share for r in mixing.marginals(kept).collect()}
    want = {("source", "a"): 0.25, ("source", "b"): 0.25, ("source", "c"): 0.5, ("lang", "en"): 0.5, ("lang", "de"): 0.5}
    assert all(abs(got[k] - v) < 0.03 for k, v in want.items())
    total = sum(len(t.split()) for _, t, *_ in rows)
    assert abs(kept.agg({"_tokens": "sum"}).first()[0] / total - 0.7) < 0.03


def test_oracles_are_sql():
    from loomlake.llm import registry

    assert all(isinstance(x, str) for x in registry.ORACLE_SQL.values())
