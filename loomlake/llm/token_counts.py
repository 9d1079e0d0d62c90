"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole. Its tokens' character spans are joined with the spans of its fields
or sections, and a token that crosses a boundary is allocated by an explicit rule, so that the sections'
counts add up to the document's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm.bpe import Codec, codec
from loomlake.llm.common import batched, read

#: ``start``: the section of the token's first character; ``most``: the one with most of its characters, the first of equals.
RULES = ("start", "most")


def token_spans(own: Codec, text: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and character after the last of each token. A token that is a part of one character has that character's span."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    ids, _ = own.encode(text)
    ends = np.cumsum(own.lengths[ids])
    of = np.cumsum((data & 0xC0) != 0x80) - 1  # character of each byte
    return of[np.concatenate(([0], ends[:-1]))] if len(ids) else ids.astype(np.int64), (of[ends - 1] + 1 if len(ids) else ids.astype(np.int64))


def attribute(starts: np.ndarray, stops: np.ndarray, section_starts: np.ndarray, section_stops: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whole tokens by the rule, tokens by share of characters, tokens that cross its edge) of each section.

    Sections are disjoint and sorted; characters outside all of them count for none, also in the shares.
    """
    n = len(section_starts)
    whole, share, crossing = np.zeros(n + 1, np.int64), np.zeros(n + 1), np.zeros(n + 1, np.int64)
    if n and len(starts):
        first = np.searchsorted(section_stops, starts, "right")  # first section that ends after the token's start
        last = np.searchsorted(section_starts, stops, "left") - 1  # last section that starts before the token's end
        inside = (first == last) & (section_starts[np.minimum(first, n - 1)] <= starts) & (stops <= section_stops[np.minimum(first, n - 1)])
        counts = np.bincount(first[inside], minlength=n + 1)
        whole += counts
        share += counts
        for t in np.flatnonzero(~inside & (last >= first)):  # only tokens over a boundary
            over = np.arange(first[t], last[t] + 1)
            chars = np.minimum(stops[t], section_stops[over]) - np.maximum(starts[t], section_starts[over])
            share[over] += chars / (stops[t] - starts[t])
            crossing[over[chars > 0]] += 1
            if rule == "most":
                rest = (stops[t] - starts[t]) - chars.sum()
                if chars.max() >= rest:
                    whole[over[chars.argmax()]] += 1
            elif section_starts[over[0]] <= starts[t]:
                whole[over[0]] += 1
    return whole[:n], share[:n], crossing[:n]


def section_tokens(docs: DataFrame, ranks_path: str, pattern: str, sections: str | None = None, rule: str = "most", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, section, name, start_char, end_char, n_tokens, token_share, n_crossing, doc_tokens), a row for each section of each row.

    ``sections`` names an array<struct<name, start, stop>> column of disjoint character spans [start, stop) in ascending
    order; None: the lines of the text, each with its line end, named ``line``. n_tokens is whole tokens by
    ``rule`` (one of RULES), token_share splits a crossing token by characters, n_crossing counts the tokens that
    touch more than the section. With sections that cover the text, n_tokens add up to doc_tokens. A
    null or empty text has one empty line, or the given sections without tokens; a null section list gives no rows. Spans
    are clipped to the text. A narrow map: nothing is shuffled, memory is one document's tokens.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    kind = docs.schema[id_column].dataType.simpleString()
    columns = [F.col(id_column).alias("doc_id"), F.col(text_column).alias("_text")]
    if sections:
        columns += [F.transform(sections, lambda s: s["name"].cast("string")).alias("_names"), F.transform(sections, lambda s: s["start"].cast("long")).alias("_starts"), F.transform(sections, lambda s: s["stop"].cast("long")).alias("_stops")]

    def run(batches):
        own = codec(ranks_path, pattern)
        for batch in batches:
            row, parts, names = [], [], []
            for i, x in enumerate(batch.column(1)):
                text = x.as_py() or ""
                if sections:
                    given = batch.column(3)[i].as_py()
                    if given is None:
                        continue
                    begin, end = (np.clip(np.array(batch.column(c)[i].as_py(), np.int64), 0, len(text)) for c in (3, 4))
                    names += batch.column(2)[i].as_py()
                else:
                    end = np.cumsum([len(line) + 1 for line in text.split("\n")])
                    begin = end - np.diff(end, prepend=0)
                    end[-1] = len(text)
                    names += ["line"] * len(end)
                starts, stops = token_spans(own, text)
                parts.append((np.arange(len(begin)), begin, end, *attribute(starts, stops, begin, end, rule), np.full(len(begin), len(starts))))
                row += [i] * len(begin)
            c = [np.concatenate(p) for p in zip(*parts, strict=True)] or [np.array([], np.int64)] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(c[0].astype(np.int32)), pa.array(names, pa.string()), pa.array(c[1].astype(np.int64)), pa.array(c[2].astype(np.int64)),
                 pa.array(c[3].astype(np.int64)), pa.array(c[4].astype(float)), pa.array(c[5].astype(np.int64)), pa.array(c[6].astype(np.int64))],
                ["doc_id", "section", "name", "start_char", "end_char", "n_tokens", "token_share", "n_crossing", "doc_tokens"])

    return batched(docs).select(*columns).mapInArrow(run, f"doc_id {kind}, section int, name string, start_char bigint, end_char bigint, n_tokens bigint, token_share double, n_crossing bigint, doc_tokens bigint")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return section_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
