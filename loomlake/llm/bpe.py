"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

The nondeterministic machine reads bytes along a trie of the vocabulary; at the end of a token it may
emit it if the token is compatible with the one before, that is, if merging the two tokens' bytes by rank
gives just these two tokens again. A sequence of tokens is the result of the merges exactly if every
neighbouring pair is compatible, so every text has one accepting path. The machine is
determinised as bytes come in: a state is the set of open paths, each with the tokens it has not yet
emitted; what all paths agree on is emitted at once. A path dies when the trie ends, so a token is
emitted after a lookahead of at most the longest token.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm.common import batched, read, remembered, works_for

#: Bounds of the memory a Python worker takes; past them tables are emptied and filled anew. No result depends on them.
MAX_STATES, MAX_PIECES, MAX_PAIRS = 300_000, 150_000, 500_000
#: A move is the state it leads to, and above these bits the place of what it emits (0: nothing).
STATE_BITS, STATE_MASK = 32, (1 << 32) - 1
#: Ids decoded at a time.
DECODE_IDS = 65_536


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes, a space, its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class MergeTransducer:
    """Encodes pieces of bytes by the merge ranks; see the module's text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}
        self.token = [-1]
        self.inner = [False]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                key = node << 8 | b
                self.inner[node] = True
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
            self.token[node] = rank
        self.fits: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.moves: dict[int, int] = {}
        self.ids: dict[bytes, int] = {}
        self.paths: list[bytes] = []
        self.places: dict[tuple[int, ...], int] = {(): 0}
        self.outs: list[tuple[int, ...]] = [()]
        self.last_out: list[int] = []
        self.start = self._state([((), -1, 0)])

    def _state(self, paths: list[tuple[tuple[int, ...], int, int]]) -> int:
        """A state's paths are kept as numbers in one bytes object: as tuples they took most of a worker's memory."""
        flat: list[int] = []
        for pending, last, node in paths:
            flat += (len(pending), *pending, last, node) if pending else (0, last, node)
        packed = array("i", flat).tobytes()
        found = self.ids.get(packed)
        if found is None:
            found = self.ids[packed] = len(self.paths)
            self.paths.append(packed)
            self.last_out.append(self._out(paths[-1][0]))
        return found

    def _out(self, tokens: tuple[int, ...]) -> int:
        found = self.places.get(tokens)
        if found is None:
            found = self.places[tokens] = len(self.outs)
            self.outs.append(tokens)
        return found

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' bytes, lowest rank first and leftmost of equals, gives the two again; left -1: none."""
        key = left << 32 | right
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > MAX_PAIRS:
                self.fits.clear()
            found = self.fits[key] = self._merges_to(self.bytes_of.get(left, b""), self.bytes_of[right])
        return found

    def _merges_to(self, left: bytes, right: bytes) -> bool:
        data, rank, none = left + right, self.ranks.get, 1 << 60
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [rank(data[i : i + 2], none) for i in range(len(data) - 1)]
        border = len(left)  # parts that belong to the left token
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            if at == border - 1:
                return False
            if at < border:
                border -= 1
            parts[at] += parts.pop(at + 1)
            ranks.pop(at)
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], none)
        return len(parts) == (2 if left else 1)

    def _step(self, state: int, b: int) -> int:
        """Determinise one move."""
        paths, whole, child_of, fits = [], None, self.child.get, self.fits.get
        flat, end = array("i", self.paths[state]).tolist(), -2
        while (at := end + 2) < len(flat):
            end = at + 1 + flat[at]
            child = child_of(flat[end + 1] << 8 | b)
            if child is None:
                continue
            if self.inner[child]:
                paths.append((tuple(flat[at + 1 : end]), flat[end], child))
            token = self.token[child]
            if token >= 0 and whole is None:
                found = fits(flat[end] << 32 | token)
                if found or found is None and self._compatible(flat[end], token):
                    whole = ((*flat[at + 1 : end], token), token, 0)
        if whole is None:
            raise ValueError(f"the vocabulary has no token for byte {b}")
        paths.append(whole)
        first, same = paths[0][0], 0
        if first:
            shortest = min([len(p[0]) for p in paths])
            while same < shortest and all([p[0][same] == first[same] for p in paths]):
                same += 1
        rest = [(pending[same:], last, node) for pending, last, node in paths] if same else paths
        to = self._state(rest)
        move = self.moves[state << 8 | b] = self._out(first[:same]) << STATE_BITS | to if same else to
        return move

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.paths) > MAX_STATES:
            self._reset()
        state, out, move, outs = self.start, [], self.moves.get, self.outs
        for b in piece:
            state = move(state << 8 | b) or self._step(state, b)  # no move leads to the start, which is 0
            if state > STATE_MASK:
                out += outs[state >> STATE_BITS]
                state &= STATE_MASK
        out += outs[self.last_out[state]]
        return out


class Utf8Stream:
    """Incremental UTF-8: text comes out as soon as it is whole, an unfinished character waits for the next bytes."""

    def __init__(self, errors: str = "replace"):
        self._machine = codecs.getincrementaldecoder("utf-8")(errors)

    def push(self, data: bytes, last: bool = False) -> str:
        return self._machine.decode(data, last)


class Codec:
    """Encodes and decodes texts. Pieces are remembered up to MAX_PIECES."""

    def __init__(self, ranks_path: str, pattern: str):
        self.machine = MergeTransducer(load_ranks(ranks_path))
        self.find = regex.compile(pattern).findall
        size = max(self.machine.bytes_of) + 1
        self.vocabulary = [self.machine.bytes_of.get(i, b"") for i in range(size)]
        self.lengths = np.array([len(x) for x in self.vocabulary], np.int64)
        self.names = [str(i) for i in range(size)]
        self.pieces: dict[str, tuple[bytes, str]] = {}

    def _piece(self, piece: str) -> tuple[bytes, str]:
        ids, names = self.machine.encode(piece.encode("utf-8", "surrogatepass")), self.names
        if len(self.pieces) >= MAX_PIECES:
            self.pieces.clear()
        found = self.pieces[piece] = (array("I", ids).tobytes(), " ".join([names[x] for x in ids]))
        return found

    def each(self, text: str) -> list[tuple[bytes, str]]:
        get, make = self.pieces.get, self._piece
        return [get(piece) or make(piece) for piece in self.find(text)]

    def encode(self, text: str | None) -> tuple[np.ndarray, str]:
        """Ids, and the same as decimal numbers joined by one space."""
        both = self.each(text or "")
        return np.frombuffer(b"".join([x[0] for x in both]), np.uint32), " ".join([x[1] for x in both])

    def token_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))

    def decode(self, ids: np.ndarray) -> Iterator[tuple[bytes, str]]:
        """Bytes and the text known so far, a block of ids at a time."""
        stream = Utf8Stream()
        for at in range(0, len(ids), DECODE_IDS):
            data = self.token_bytes(ids[at : at + DECODE_IDS].tolist())
            yield data, stream.push(data, at + DECODE_IDS >= len(ids))


_CODECS: dict[tuple[str, str], Codec] = remembered("bpe", {})


def codec(ranks_path: str, pattern: str) -> Codec:
    """The Python worker's codec; reused by later tasks."""
    works_for("bpe")
    if (ranks_path, pattern) not in _CODECS:
        _CODECS.clear()
        _CODECS[ranks_path, pattern] = Codec(ranks_path, pattern)
    return _CODECS[ranks_path, pattern]


def _mapped(docs: DataFrame, kept: list[str], column: str, make, schema: str) -> DataFrame:
    """``make(values) -> columns`` of ``column`` over Arrow batches, beside the ``kept`` columns; no shuffle."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *make(batch.columns[-1])], names)

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    names = [*kept, *(x.split()[0] for x in schema.split(", "))]
    return batched(docs).select(*kept, F.col(column).alias("_value")).mapInArrow(run, ", ".join([*kinds, schema]))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids array<int>): every whole text's token ids; a null or empty text has none.

    A narrow map: rows are kept as they come (ties, repeated rows, null ids), other columns are not read.
    """

    def make(texts):
        own = codec(ranks_path, pattern)
        return [pa.array([own.encode(x.as_py())[0].astype(np.int32) for x in texts], pa.list_(pa.int32()))]

    return _mapped(docs, [id_column], text_column, make, "ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, text string): the ids' text; null ids are an empty text; bytes that are no UTF-8 become U+FFFD."""

    def make(rows):
        own = codec(ranks_path, pattern)
        return [pa.array(["".join(text for _, text in own.decode(np.array(x.as_py() or [], np.uint32))) for x in rows], pa.string())]

    return _mapped(encoded, [id_column], ids_column, make, "text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, decoded_chars): encode every whole text, decode its ids again, digest both.

    A null text is an empty one (no tokens, the digests of nothing). Memory is one document's ids.
    """

    def make(texts):
        own, rows = codec(ranks_path, pattern), []
        for x in texts:
            ids, numbers = own.encode(x.as_py())
            decoded, chars = hashlib.sha256(), 0
            for data, text in own.decode(ids):
                decoded.update(data)
                chars += len(text)
            rows.append((len(ids), hashlib.sha256(numbers.encode()).hexdigest(), decoded.hexdigest(), chars))
        n, a, b, c = zip(*rows, strict=True) if rows else ((), (), (), ())
        return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c, pa.int64())]

    return _mapped(docs, [id_column], text_column, make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, decoded_chars bigint")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def checked_ids(docs: DataFrame, ranks_path: str, pattern: str, kept: list[str], text_column: str = "text") -> DataFrame:
    """(kept columns, n_tokens, ids array<int>, same boolean): every whole text's ids, and whether decoding them gives the text again."""

    def make(texts):
        own, rows = codec(ranks_path, pattern), []
        for x in texts:
            text = x.as_py() or ""
            ids, _ = own.encode(text)
            rows.append((len(ids), ids.astype(np.int32), "".join(part for _, part in own.decode(ids)) == text))
        n, ids, same = zip(*rows, strict=True) if rows else ((), (), ())
        return [pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())]

    return _mapped(docs, kept, text_column, make, "n_tokens bigint, ids array<int>, same boolean")
