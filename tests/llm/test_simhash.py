import numpy as np
import pytest
import xxhash

from loomlake.llm import simhash


def plain(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def groups(values, budget):
    values, parent = sorted(set(values)), {}
    find = lambda x: x if parent.get(x, x) == x else find(parent[x])
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= budget and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in values}


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "one TWO", "a b c", "a b c d e a b c d", "É é\x0bx\x1fy z", "w " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


@pytest.mark.parametrize("depth", [0, 3])
def test_walk_finds_all_links(depth):
    rng = np.random.default_rng(depth)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = {int(s) for s in seeds}
    for s in seeds[:20]:
        for _ in range(12):
            x = int(s)
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                x ^= 1 << int(b)
            values.add(x)
    trees = {}
    for v in sorted(values):
        trees.setdefault(v >> (64 - depth) if depth else 0, []).append(v)
    found = set()
    for p, a in trees.items():
        for q, b in trees.items():
            if p <= q and (p ^ q).bit_count() <= 2:
                x, y = np.array(a, np.uint64), np.array(b, np.uint64)
                for i, j in simhash._linked(x, y, p == q, depth, (p ^ q).bit_count(), 2):
                    found |= {frozenset((int(u), int(v))) for u, v in zip(x[i], y[j], strict=True)}
    assert found == {frozenset((a, b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2}


def test_components_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SUBTREE", 8)
    base = "the quick brown fox jumps over the lazy dog and runs along the river bank until night falls on " * 4
    words = base.split()
    rows = [(i, " ".join(words[:60 + i % 7] + [f"w{i // 3}"])) for i in range(60)]
    rows += [(100, None), (101, ""), (102, None), (103, "solo"), (103, "solo"), (None, "solo"), (None, "only null id here")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, bits int, root string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    root = groups([plain(t) for _, t in rows], 2)
    least = {}
    for i, t in rows:
        g = root[plain(t)]
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    assert got == sorted(((i, f"{plain(t):016x}", least[root[plain(t)]]) for i, t in rows), key=str)


@pytest.mark.parametrize("most", [1 << 17, 9])
def test_links_across_subtrees(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "SUBTREE", 16)
    monkeypatch.setattr(simhash, "SUBTREE_MOST", most)
    rng = np.random.default_rng(5)
    values = {int(x) for x in rng.integers(0, 1 << 63, 150, dtype=np.uint64)}
    values |= {x ^ (1 << int(b)) for x in list(values)[:100] for b in (63, 62, 61, 60, 3)}
    bits = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in values], "bits bigint")
    links = simhash.near_links(bits)
    root = {r.node: r.root for r in simhash.components(links).collect()}
    want = groups(values, 2)
    signed = lambda x: int(np.uint64(x).view(np.int64))
    got, expected = {}, {}
    for x in values:
        got.setdefault(root.get(signed(x), signed(x)), set()).add(x)
        expected.setdefault(want[x], set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a bigint, b bigint")
    assert {(r.node, r.root) for r in simhash.components(links).collect()} == {(i, 0) for i in range(41)} | {(99, 99), (100, 99)}


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_walk_of_near_keys_holds_little():
    import tracemalloc

    rng = np.random.default_rng(3)
    keys = np.full(6000, 0x123456789ABCDEF0, np.uint64)
    for _ in range(6):
        keys ^= np.uint64(1) << rng.integers(0, 64, len(keys), dtype=np.uint64)
    keys = np.sort(keys)
    tracemalloc.start()
    n = sum(len(i) for i, _ in simhash._linked(keys, keys, True, 0, 0, 10))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == sum(int((np.bitwise_count(keys[:at] ^ keys[at]) <= 10).sum()) for at in range(len(keys)))
    assert peak < 45_000_000


def test_small_blocks_find_the_same_groups(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i // 10 * 3 : i // 10 * 3 + 60] + [f"x{i}"])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(simhash.near_copies(docs).collect())
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", 500)
    assert sorted(simhash.near_copies(docs).collect()) == whole
