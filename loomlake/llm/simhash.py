"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Distinct fingerprints are cut into subtrees by a prefix of bits deep enough that each subtree is small.
Every pair of subtrees whose prefixes differ in at most the budget is one task's work: it walks
the two subtrees together, bit by bit, adds up differing bits and drops a pair of nodes as soon as the
budget is exceeded. Fingerprints are distinct, so one has at most C(64,1)+C(64,2) partners at two bits and
the walk can't grow with the square of a group of copies. A task emits a star for each group it finds; the
stars are joined to components by rounds of minimum labels.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm.common import batched, free_prefix, read, staged, works_for

SEED = 42
#: Contract of the query: words of a shingle, bits that linked fingerprints differ in at most.
SHINGLE_WORDS, MAX_BITS = 3, 2
#: Fingerprints of a subtree: sought, and at most (then the prefix is made longer).
SUBTREE, SUBTREE_MOST = 1 << 14, 1 << 17
#: Pairs of nodes and pairs of leaves held at once, and pairs of leaves that are compared without further descent.
FRONTIER, LEAVES, LEAF_PAIRS = 1 << 16, 1 << 16, 16
#: Near copies: bits of a fingerprint, chance that a pair at the threshold is met in some trie.
WIDE, RECALL = 256, 0.97
#: Exact check of near copies: texts and shingles of a block, and partners that a text meets before all others.
BLOCK_TEXTS, BLOCK_SHINGLES, NEAREST = 1 << 13, 1 << 21, 8
#: Shingles hashed at once.
BLOCK = 1 << 16


def _shingle_hashes(text: str | None, words_per_shingle: int) -> np.ndarray:
    """XXH64 of each shingle in turn; of a text of fewer words: of all its words; without words: none."""
    works_for("simhash")
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    data, k = b" ".join(words), words_per_shingle
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - k + 1)
    first, last = starts[:n].tolist(), (ends[k - 1 :] if len(words) >= k else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(data[s:e], SEED) for s, e in zip(first, last, strict=True)], np.uint64)


def _sign_bits(shingles: np.ndarray, parts: int) -> bytes:
    """``parts`` 64-bit SimHashes, big-endian: of the shingles' XXH64, then of multiples of it that are mixed once more."""
    n = len(shingles)
    counts = np.zeros(64 * parts, np.int64)
    for at in range(0, n, BLOCK):
        own = shingles[at : at + BLOCK]
        for part in range(parts):
            x = own
            if part:
                x = own * np.uint64(0x9E3779B97F4A7C15 + 2 * part)
                x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            hashes = x.astype(">u8").view(np.uint8).reshape(-1, 8)
            counts[64 * part : 64 * part + 64] += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n).tobytes()


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash: A-Z lower-cased, words parted by ASCII white space, bit set if in over half the shingle hashes."""
    return int.from_bytes(_sign_bits(_shingle_hashes(text, words_per_shingle), 1), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, bits long): the fingerprint of every whole text as a signed long. A narrow map."""

    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(x.as_py(), words_per_shingle) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["doc_id", "bits"])

    kind = docs.schema[id_column].dataType.simpleString()
    return batched(docs).select(F.col(id_column).alias("doc_id"), text_column).mapInArrow(run, f"doc_id {kind}, bits bigint")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _linked(a: np.ndarray, b: np.ndarray, same: bool, depth: int, spent: int, budget: int, nodes: np.ndarray | None = None, label: np.ndarray | None = None):
    """Yield (i, j) index arrays of a's and b's leaves within the budget; both sorted, each with one prefix of ``depth`` bits.

    ``nodes``: instead of the whole trees, pairs of nodes of that depth to begin with, as rows (start, stop, start, stop, spent).
    ``label``: groups of a's leaves (``same`` only), which may be joined between two yields; what lies in one group isn't compared.
    """
    todo = [(depth, np.array([[0], [len(a)], [0], [len(b)], [spent]], np.int64) if nodes is None else nodes)]
    zeros: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def split(level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in zeros:
            bit = np.uint64(63 - level)
            zeros[level] = tuple(np.concatenate(([0], np.cumsum((x >> bit) & np.uint64(1) == 0))) for x in ((a,) if same else (a, b)))
            if same:
                zeros[level] *= 2
        return zeros[level]

    while todo:
        level, pairs = todo.pop()
        if label is not None:
            a0, a1, b0, b1, _ = pairs
            changes = np.cumsum(np.diff(label, prepend=label[:1]) != 0)
            pairs = pairs[:, (changes[a0] != changes[a1 - 1]) | (changes[b0] != changes[b1 - 1]) | (label[a0] != label[b0])]
        a0, a1, b0, b1, d = pairs
        small = (a1 - a0) * (b1 - b0) <= LEAF_PAIRS
        if small.any():
            yield from _leaves(a, b, same, pairs[:, small], budget, label)
            a0, a1, b0, b1, d = pairs[:, ~small]
        if not len(d):
            continue
        if level < 64:
            za, zb = split(level)
            am, bm, more = a0 + za[a1] - za[a0], b0 + zb[b1] - zb[b0], d + 1
        else:  # many leaves of equal keys: halves
            am, bm, more = (a0 + a1) // 2, (b0 + b1) // 2, d
        new = [np.stack([a0, am, b0, bm, d]), np.stack([am, a1, bm, b1, d]), np.stack([a0, am, bm, b1, more])]
        cross = np.stack([am, a1, b0, bm, more])
        new.append(cross[:, a0 != b0] if same else cross)  # of a node with itself, one of the two mixed pairs is enough
        pairs = np.concatenate(new, axis=1)
        pairs = pairs[:, (pairs[0] < pairs[1]) & (pairs[2] < pairs[3]) & (pairs[4] <= budget)]
        todo += [(min(level + 1, 64), pairs[:, at : at + FRONTIER]) for at in range(0, pairs.shape[1], FRONTIER)]


def _leaves(a, b, same, pairs, budget, label=None):
    """The pairs of leaves under ``pairs`` of nodes that are within the budget; about LEAVES are held at once."""
    counts = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
    part = np.cumsum(counts) // LEAVES
    for at, stop in zip(cuts := np.flatnonzero(np.diff(part, prepend=-1)), np.append(cuts[1:], len(part)), strict=True):
        a0, a1, b0, b1, _ = pairs[:, at:stop]
        n = counts[at:stop]
        of = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        wide = (b1 - b0)[of]
        i, j = a0[of] + k // wide, b0[of] + k % wide
        near = _popcount(a[i] ^ b[j]) <= budget
        if same:
            near &= i < j
        if label is not None:
            near &= label[i] != label[j]
        if near.any():
            yield i[near], j[near]


def _stars(values: np.ndarray, links, label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Groups that the links form: each value but a group's first, with that first. ``label`` (at first its own places) is kept up to date in place."""
    label = np.arange(len(values)) if label is None else label
    for i, j in links:
        while True:
            i, j = label[i], label[j]
            apart = i != j
            if not apart.any():
                break
            i, j = i[apart], j[apart]
            np.minimum.at(label, np.maximum(i, j), np.minimum(i, j))
            while (label[label] != label).any():
                label[:] = label[label]
    member = np.flatnonzero(label != np.arange(len(values)))
    return values[member], values[label[member]]


def _subtree_bits(bits: DataFrame) -> int:
    """Bits of the prefix: enough for subtrees of SUBTREE on average."""
    return max(0, math.ceil(math.log2(max(1, bits.count()) / SUBTREE)))


def _prefix(depth: int):
    return F.shiftrightunsigned("bits", 64 - depth) if depth else F.lit(0).cast("long")


def near_links(bits: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """(a, b): a forest that joins distinct fingerprints ``bits`` differing in at most ``budget`` bits.

    ``bits`` must be distinct. Each subtree goes to the tasks of all prefixes within the budget, also its own. A subtree of over
    SUBTREE_MOST leaves is dealt to blocks, and each pair of blocks of two prefixes (or of one) is a task: others are not made longer by it.
    """
    depth = _subtree_bits(bits)
    masks = [sum(1 << x for x in c) for r in range(min(budget, depth) + 1) for c in combinations(range(depth), r)]
    leaves = bits.select("bits", _prefix(depth).alias("prefix"))
    large = leaves.groupBy("prefix").count().where(F.col("count") > SUBTREE_MOST)
    large = staged(large.select("prefix", F.ceil(F.col("count") / SUBTREE_MOST).cast("int").alias("blocks")), "simhash-large")  # a row for SUBTREE_MOST leaves at most
    leaves = leaves.join(large, "prefix", "left").withColumn("block", F.pmod(F.xxhash64("bits"), F.coalesce("blocks", F.lit(1))).cast("int"))
    trees = leaves.groupBy("prefix", "block").agg(F.sort_array(F.collect_list("bits")).alias("leaves"))
    sides = trees.select("prefix", "block", "leaves", F.explode(F.array(*[F.lit(x).cast("long") for x in masks])).alias("mask")).withColumn("other", F.col("prefix").bitwiseXOR(F.col("mask")))
    sides = sides.join(large.select(F.col("prefix").alias("other"), "blocks"), "other", "left").withColumn("meets", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    # the two blocks of a task, that of the lower prefix first; of one prefix the lower block first
    first = F.when(F.col("prefix") == F.col("other"), F.col("block") <= F.col("meets")).otherwise(F.col("prefix") < F.col("other"))
    sides = sides.select(F.least("prefix", "other").alias("low"), F.greatest("prefix", "other").alias("high"), F.when(first, F.col("block")).otherwise(F.col("meets")).alias("one"), F.when(first, F.col("meets")).otherwise(F.col("block")).alias("two"), "prefix", "block", "leaves")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        trees = {(int(p), int(b)): np.sort(np.asarray(x, np.int64).view(np.uint64)) for p, b, x in zip(pdf["prefix"], pdf["block"], pdf["leaves"], strict=True)}
        low, high, one, two = (int(pdf[c].iloc[0]) for c in ("low", "high", "one", "two"))
        if (low, one) not in trees or (high, two) not in trees:
            return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
        a, b = trees[low, one], trees[high, two]
        same = (low, one) == (high, two)
        links = _linked(a, b, same, depth, (low ^ high).bit_count(), budget)
        if not same:
            links = ((i, j + len(a)) for i, j in links)
        member, root = _stars(a if same else np.concatenate((a, b)), links)
        return pd.DataFrame({"a": member.view(np.int64), "b": root.view(np.int64)})

    return sides.groupBy("low", "high", "one", "two").applyInPandas(walk, "a bigint, b bigint")


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); root: the component's smallest node.

    Alternating large-star and small-star rounds, each written to the shared folder; the number of rounds
    grows with the logarithm of the longest path.
    """
    edges = staged(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(low.select("a", F.col("m").alias("b"))).distinct()
        edges = staged(small, label)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())


def _alike_nodes(keys: np.ndarray, depth: int) -> np.ndarray:
    """The trie's nodes of ``depth`` bits that have two leaves or more, each as a pair with itself."""
    start = np.flatnonzero(np.diff(keys >> np.uint64(64 - depth), prepend=keys[:1] >> np.uint64(64 - depth)))
    start = np.concatenate(([0], start))
    stop = np.append(start[1:], len(keys))
    many = stop - start > 1
    return np.stack([start[many], stop[many], start[many], stop[many], np.zeros(many.sum(), np.int64)])


def _alike(own: np.ndarray, others: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which sorted sets have a Jaccard similarity to ``own`` of ``similarity`` or more."""
    sizes = np.array([len(x) for x in others])
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, every), len(own) - 1)
    shared = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
    return shared / (len(own) + sizes - shared) >= similarity


def _exact_links(sets: list[np.ndarray], wide: np.ndarray, block: np.ndarray, label: np.ndarray, most: int, similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) that join the texts' groups in ``label`` over all pairs of ``similarity`` or more whose bits differ in ``most`` at most.

    Each text meets its NEAREST first; then all that are not in its group by then. ``block``: texts of one block aren't compared, unless all are of one.
    """
    links, size, apart = [], np.array([len(x) for x in sets]), (block != block[0]).any()

    def partners(i: int, most_of_them: int | None) -> np.ndarray:
        d = _popcount(wide[i] ^ wide[i + 1 :]).sum(axis=1, dtype=np.int64)
        other = size[i + 1 :]
        near = (d <= most) & (label[i + 1 :] != label[i]) & (np.minimum(other, size[i]) >= similarity * np.maximum(other, size[i]) - 1e-6)
        if apart:
            near &= block[i + 1 :] != block[i]
        found = np.flatnonzero(near)
        return i + 1 + found[np.argsort(d[found], kind="stable")][:most_of_them]

    def meet(i: int, found: np.ndarray) -> None:
        for j in found[_alike(sets[i], [sets[j] for j in found], similarity)]:
            if label[i] != label[j]:
                links.append((i, int(j)))
                label[label == max(label[i], label[j])] = min(label[i], label[j])

    for nearest in (NEAREST, None) if len(sets) > NEAREST else (None,):
        for i in range(len(sets) - 1):
            found, many = partners(i, nearest), NEAREST
            while len(found):
                meet(i, found[:many])
                found = found[many:]
                found, many = found[label[found] != label[i]], 8 * many
    return links


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) for every row: groups of texts linked by shingles that are alike by ``similarity`` (Jaccard) or more.

    At such a similarity a 64-bit SimHash differs in about ten bits, far more than a trie can be searched for at
    once. So each set of shingles gets 256 bits, and a number of tries is made, each over another random choice of 64 of them. In a trie,
    nodes of a prefix about as long as the logarithm of the number of sets are walked against themselves with
    the whole budget of bits. The number of tries is set so that a pair at the threshold shares the prefix in one of them with
    probability RECALL; a pair of leaves is a candidate if its bits differ in no more than such a pair's expected bits and three
    deviations. A task emits a forest of its candidates and does not compare what is in one group by then, so
    groups of copies cost no squares here. All forests together give groups of candidates.

    Bits only propose: inside a group, texts are linked by the exact Jaccard similarity of their shingle sets. Sets are made for texts in groups
    only. A text meets its nearest partners first and then all that its links did not join it to, so the
    work grows with the square only of texts that are near a group and in none. Groups of over BLOCK_TEXTS texts
    or BLOCK_SHINGLES shingles are dealt to blocks: first each block, then each pair of blocks is a task, less what is joined.
    Leaves of over SUBTREE_MOST in one subtree of a trie are dealt to pairs of blocks as well.

    Texts without words are one group. Equal sets of shingles are one node, so copies and repeated rows cost one comparison; a row with a null id
    counts as the largest. An empty table gives no rows. Other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    texts = batched(docs).select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def print_all(batches):
        for batch in batches:
            sets = [np.unique(_shingle_hashes(x.as_py(), words_per_shingle)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], pa.uint64()).view(pa.int64()), pa.array([_sign_bits(x, WIDE // 64) for x in sets], pa.binary()), pa.array([len(x) for x in sets], pa.int64())],
                ["doc_id", "node", "bits", "size"])

    printed = staged(texts.mapInArrow(print_all, f"doc_id {kind}, node bigint, bits binary, size bigint"), "simhash-wide")
    nodes = staged(printed.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("bits").alias("bits"), F.min("size").alias("size")), "simhash-wide-nodes")
    # Jaccard s is a cosine of 2s / (1 + s) at least
    differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
    budget, most = (round(bits * differ + 3 * math.sqrt(bits * differ * (1 - differ))) for bits in (64, WIDE))
    n = max(1, nodes.count())
    depth = max(4, math.ceil(math.log2(n)) - 2)
    tries = math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - differ) ** depth))
    coarse = max(0, math.ceil(math.log2(n / SUBTREE)))
    rng = np.random.default_rng(SEED)
    choices = [rng.permutation(WIDE)[:64] for _ in range(tries)]

    def keys(bits: list[bytes], choice: np.ndarray) -> np.ndarray:
        each = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1)
        return np.packbits(np.ascontiguousarray(each[:, choice]), axis=1).copy(order="C").view(">u8").ravel().astype(np.uint64)

    def tops(bits: list[bytes]):
        for t, choice in enumerate(choices):
            key = keys(bits, choice)
            yield t, (key >> np.uint64(64 - coarse)).astype(np.int64) if coarse else np.zeros(len(key), np.int64)

    def deal(batches):
        for batch in batches:
            for t, top in tops(batch.column(0).to_pylist()) if len(batch) else ():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), t, np.int32)), pa.array(top), *batch.columns], ["trie", "top", *batch.schema.names])

    def counted(batches):
        for batch in batches:
            for t, top in tops(batch.column(0).to_pylist()) if len(batch) else ():
                top, count = np.unique(top, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), t, np.int32)), pa.array(top), pa.array(count)], ["trie", "top", "n"])

    def blocked() -> DataFrame:
        """The leaves dealt to all tries, with block and the pair of blocks (low, high) of each task they go to."""
        dealt = nodes.select("bits", "node", "size").mapInArrow(deal, "trie int, top bigint, bits binary, node bigint, size bigint")
        large = nodes.select("bits").mapInArrow(counted, "trie int, top bigint, n bigint").groupBy("trie", "top").agg(F.sum("n").alias("n")).where(F.col("n") > SUBTREE_MOST)
        large = staged(large.select("trie", "top", F.ceil(F.col("n") / SUBTREE_MOST).cast("int").alias("blocks")), "simhash-wide-large")
        if large.isEmpty():
            return dealt.select("*", *[F.lit(0).alias(x) for x in ("block", "low", "high")])
        # at most a row for SUBTREE_MOST leaves of each trie; Spark broadcasts it or not by its measured size
        dealt = dealt.join(large, ["trie", "top"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        return _paired(dealt, "blocks")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        key = keys(list(pdf["bits"]), choices[int(pdf["trie"].iloc[0])])
        order = np.argsort(key, kind="stable")
        key, wide = key[order], np.frombuffer(b"".join(pdf["bits"]), np.uint64).reshape(len(pdf), -1)[order]
        node, size, block = (pdf[x].to_numpy(np.int64)[order] for x in ("node", "size", "block"))
        label, apart = np.arange(len(key)), pdf["low"].iloc[0] != pdf["high"].iloc[0]

        def candidates():
            for i, j in _linked(key, key, True, depth, 0, budget, _alike_nodes(key, depth), label):
                near = (_popcount(wide[i] ^ wide[j]).sum(axis=1, dtype=np.int64) <= most) & (np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]) - 1e-6)
                if apart:
                    near &= block[i] != block[j]
                yield i[near], j[near]

        member, root = _stars(node, candidates(), label)
        return pd.DataFrame({"a": member, "b": root})

    found = staged(blocked().groupBy("trie", "top", "low", "high").applyInPandas(walk, "a bigint, b bigint").distinct(), "simhash-wide-found")
    groups = components(found, "simhash-wide-groups")
    members = nodes.join(groups.withColumnRenamed("root", "group"), "node")
    needed = members.groupBy("group").agg(F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    needed = staged(members.join(needed, "group").select(F.col("least").alias("of"), "node", "bits", "size", "group", "blocks"), "simhash-wide-needed")
    texts_needed, shingles_needed = needed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    small_groups = max(1, math.ceil(texts_needed / BLOCK_TEXTS), math.ceil(shingles_needed / BLOCK_SHINGLES))
    needed = needed.drop("size")

    def shingled(batches):
        for batch in batches:
            sets = [np.unique(_shingle_hashes(x.as_py(), words_per_shingle)) for x in batch.column(0)]
            digests = pa.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], pa.uint64()).view(pa.int64())
            # of texts under one id, and of repeated rows, those that are the node
            yield pa.RecordBatch.from_arrays([digests, pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())), *batch.columns[1:]], ["digest", "shingles", *batch.schema.names[1:]])

    def sets_of(chosen: DataFrame) -> DataFrame:
        rows = texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("of"))).select("text", *[c for c in chosen.columns if c != "of"])
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
        return rows.mapInArrow(shingled, f"digest bigint, shingles array<bigint>, {kinds}").where("digest = node").drop("digest")

    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node").sort_values(["group", "node"])
        links = []
        for _, own in pdf.groupby("group", sort=False):
            if len(own) > 1:
                sets = [np.asarray(x, np.int64).view(np.uint64) for x in own["shingles"]]
                label = np.unique(own["root"].to_numpy(np.int64), return_inverse=True)[1]
                node, wide = own["node"].to_numpy(np.int64), np.frombuffer(b"".join(own["bits"]), np.uint64).reshape(len(own), -1)
                links += [(node[i], node[j]) for i, j in _exact_links(sets, wide, own["block"].to_numpy(), label, most, similarity)]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    def checked(chosen: DataFrame, label: str) -> DataFrame:
        return staged(sets_of(chosen).groupBy("team", "low", "high").applyInPandas(check, "a bigint, b bigint"), label)

    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    inside = needed.select("*", F.col("node").alias("root"), own.alias("block")).select("*", F.when(F.col("blocks") > 1, F.col("group")).otherwise(F.pmod(F.xxhash64("group"), F.lit(small_groups))).alias("team"), F.col("block").alias("low"), F.col("block").alias("high"))
    links = checked(inside.drop("blocks"), "simhash-wide-links")
    many = needed.where("blocks > 1")
    if not many.isEmpty():
        roots = components(links, "simhash-wide-roots")
        across = _paired(many.join(roots, "node", "left").select("of", "node", "bits", "group", "blocks", F.coalesce("root", "node").alias("root"), F.col("group").alias("team")), "blocks")
        links = links.union(checked(across.where("low < high"), "simhash-wide-links"))
    roots = components(links, "simhash-wide-roots")
    rooted = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    # written first: then the join below is of two plain exchanges, which Spark splits where one group has most rows
    least = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-wide-least")
    classes = staged(rooted.join(least, "root").select("node", "component_id"), "simhash-wide-components")
    return printed.select("doc_id", "node").join(classes, "node").select("doc_id", "component_id")


def _paired(rows: DataFrame, blocks: str) -> DataFrame:
    """``rows`` with ``block`` (by a hash of the node) and once for each pair of blocks (low, high) that it is in."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
    return rows.select("*", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high")).drop(blocks, "_other")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns, less near copies: of each group the row of the least id stays (null ids count as the largest).

    Rows are told apart by id and text, so one id may stand for several texts; rows equal in both are one document, of which the row
    stays that is least as JSON text. Only narrow columns are grouped; texts move only if the rows to drop, or those to compare, are too
    many for Spark to broadcast.
    """
    key = free_prefix(docs, ["key"]) + "key"
    keyed = docs.withColumn(key, F.struct(F.col(id_column).isNull().alias("last"), F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text")))
    classes = staged(near_copies(keyed, key, text_column, words_per_shingle, similarity), "simhash-classes")
    dropped = classes.where("doc_id != component_id").select(F.col("doc_id").alias(key)).distinct()
    again = classes.where("doc_id <=> component_id").groupBy(F.col("doc_id").alias(key)).count().where("count > 1").select(key)
    kept = keyed.join(dropped, key, "left_anti")
    if not again.isEmpty():
        row = F.struct(*[F.col(f"`{c}`") for c in keyed.columns])
        one = kept.join(again, key, "left_semi").groupBy(key).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
        kept = kept.join(again, key, "left_anti").unionByName(one)
    return kept.drop(key)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = SHINGLE_WORDS, budget: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    fingerprint: 16 hex digits; component_id: the smallest id among all rows whose fingerprints can be reached over
    links of at most ``budget`` differing bits, itself included. Equal fingerprints (copies, repeated
    rows) are one node. Null and empty texts have fingerprint zero, which links like any other. A null id is
    never the smallest, unless the component has no other: then component_id is null. Other columns are not read.
    """
    printed = staged(fingerprints(docs, id_column, text_column, words_per_shingle), "simhash")
    nodes = staged(printed.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(near_links(nodes.select("bits"), budget), "simhash-links")
    rooted = nodes.join(roots, nodes["bits"] == roots["node"], "left").select("bits", "least", F.coalesce("root", "bits").alias("root"))
    least = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    found = staged(rooted.join(least, "root").select("bits", "component_id"), "simhash-components")
    # the left side may hold a third of all rows under one fingerprint: both sides are plain exchanges, which Spark splits
    return printed.join(found, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
