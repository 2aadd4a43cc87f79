"""Token counts by section: whole documents encoded once, tokens joined to sections by place.

A byte-level encoding's tokens are runs of bytes, so the running sum of their lengths gives
each token's bytes and, over the UTF-8 lead bytes, its characters. Tokens and sections are both
in order, so the interval join is one bisection per document. A token that crosses a boundary
is allocated by an explicit rule:

* ``most``: to the section that holds most of its characters, the earlier one in a tie;
* ``start``: to the section in which it begins;
* ``share``: to every section by the share of its characters.

Characters outside all sections are counted by no section.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary above cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("most", "start", "share")


# Fixed value: the characters that the pattern counts as white space. A run of so many is a piece by
# itself, but for the last one before other text, and the pattern's look-ahead must not walk it.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


class Encoder:
    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.sizes = np.zeros(max(table.values()) + 1, dtype=np.int64)
        for token, number in table.items():
            self.sizes[number] = len(token)

    def tokens(self, text: str) -> list[int]:
        """The tokens of a text, long white space piece by piece as the pattern would cut it."""
        ids, done = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += self.encoding.encode_ordinary(text[done : run.start()])
            ids += self.encoding._encode_single_piece(text[run.start() : end])
            done = end
        return ids + self.encoding.encode_ordinary(text[done:])

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of every token; a token inside a character spans it whole."""
        ids = np.array(self.tokens(text), dtype=np.int64)
        end = np.cumsum(self.sizes[ids])
        data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return character[end - self.sizes[ids]], character[end - 1] + 1


def allocate(
    token_start: np.ndarray, token_end: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str = "most"
) -> np.ndarray:
    """Tokens of each section; sections are in order and do not overlap, but may leave gaps."""
    out = np.zeros(len(starts))
    if not len(starts) or not len(token_start):
        return out
    if rule == "start":
        place = np.searchsorted(starts, token_start, "right") - 1
        inside = (place >= 0) & (token_start < ends[place])
        return np.bincount(place[inside], minlength=len(starts)).astype(float)
    # Sections that touch the token: the first that ends behind its start, the last that begins before its end.
    first = np.searchsorted(ends, token_start, "right")
    last = np.searchsorted(starts, token_end, "left") - 1
    one = first == last
    span = token_end[one] - token_start[one]
    held = np.minimum(token_end[one], ends[first[one]]) - np.maximum(token_start[one], starts[first[one]])
    out += np.bincount(first[one], (held / span) if rule == "share" else held > 0, len(starts))
    for t in np.flatnonzero(first < last):
        some = slice(first[t], last[t] + 1)
        held = np.minimum(token_end[t], ends[some]) - np.maximum(token_start[t], starts[some])
        if rule == "share":
            out[some] += held / (token_end[t] - token_start[t])
        elif held.max() > 0:
            out[first[t] + int(held.argmax())] += 1
    return out


def line_spans(text: Column) -> Column:
    """One section per line, its line end included, as start and end characters."""
    lines = F.split(text, "\n")
    sizes = F.transform(lines, lambda x, i: F.length(x) + (i < F.size(lines) - 1).cast("int"))
    return F.transform(sizes, lambda n: F.struct(n.alias("size")))


def field_spans(columns: Sequence[str], joint: str) -> tuple[Column, Column]:
    """The text of several columns with ``joint`` behind each but the last, and their sizes."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    parts = [F.concat(v, F.lit(joint)) for v in values[:-1]] + values[-1:]
    return F.concat(*parts), F.array(*[F.struct(F.length(p).alias("size")) for p in parts])


def _counter(shared, rule: str):
    def count(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for texts, sections in batches:
            out = []
            for text, spans in zip(texts, sections):
                if text is None or spans is None:
                    out.append([])
                    continue
                ends = np.cumsum([s["size"] for s in spans], dtype=np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                places = encoder.offsets(text) if text else (np.zeros(0, np.int64),) * 2
                tokens = allocate(*places, starts, ends, rule)
                out.append([
                    {"section": i, "start": a, "end": b, "tokens": t}
                    for i, (a, b, t) in enumerate(zip(starts.tolist(), ends.tolist(), tokens.tolist()))
                ])
            yield pd.Series(out)

    return F.pandas_udf(count, "array<struct<section: int, start: long, end: long, tokens: double>>")


def section_tokens(
    spark: SparkSession, text: Column, sizes: Column, rule: str = "most", vocabulary: str = VOCABULARY
) -> Column:
    """Per section its characters and its tokens, for a text cut into sections of ``sizes``.

    The vocabulary is read once on the driver, a file of fixed size, and handed to the tasks.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(spark)
    with open(vocabulary, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    return _counter(shared, rule)(text, sizes)


def judge(docs: DataFrame, key: str = "doc_id", rule: str = "most", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document and line: its characters and its tokens.

    An empty text is one empty line. A null text has no line: one row of nulls with no
    tokens. Repeated rows stay.
    """
    text = F.col("text")
    counted = section_tokens(docs.sparkSession, text, line_spans(text), rule, vocabulary)
    each = docs.select(key, counted.alias("s")).select(key, F.explode_outer("s").alias("s"))
    tokens = F.coalesce(F.col("s.tokens"), F.lit(0.0))
    if rule != "share":
        tokens = tokens.cast("long")
    return each.select(key, "s.section", "s.start", "s.end", tokens.alias("n_tokens"))
