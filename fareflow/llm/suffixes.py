"""Benchmark decontamination with suffix arrays over the training documents.

Training texts stay where they are: every Arrow batch of documents is one shard with a
suffix array of its own. The words of the benchmark get numbers, all other words are zero,
so the numbers are exact. A shard's suffix array holds the word positions from which a
benchmark suffix can start at all (its first words are a start of one), sorted by their next
``window`` words. Every benchmark suffix is then searched by bisection, which yields all
places that share its first ``window`` words; runs of such places on one diagonal are the
longest verbatim matches. Items shorter than the window are searched whole.

The benchmark goes to the executors in blocks of bounded size, one pass over the documents
per block; an ordinary benchmark is one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, small_batches, stored

WINDOW = 10
# Characters of benchmark text in one block, so what is broadcast stays below some 100 MB.
BLOCK_CHARS = 8_000_000

# Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. In UTF-8 that is
# a matter of single bytes: all bytes from 0x80 on belong to words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

FOUND = (
    "n_words long, spans array<struct<start: int, length: int>>, items array<string>, "
    "matches array<struct<item: string, item_start: int, start: int, length: int>>"
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_WORD_BYTES).split() if text else []


class TestSuffixes:
    """The suffixes of a block of benchmark items as sorted search keys."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        at = {name: i for i, name in enumerate(self.names)}
        found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for name, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for start in range(len(ids) - size + 1 if ids else 0):
                found.setdefault(tuple(ids[start : start + size]), []).append((at[name], start))
        self.lengths = np.array([len(k) for k in found], dtype=np.int64)
        self.sources = list(found.values())
        low = [k + (0,) * (window - len(k)) for k in found]
        high = [k + (2**32 - 1,) * (window - len(k)) for k in found]
        self.low, self.high = self._keys(low), self._keys(high)
        self.singles = np.unique([k[0] for k in found if len(k) == 1] or [0]).astype(np.int64)
        pairs = [k[0] << 32 | k[1] for k in found if len(k) > 1]
        self.pairs = np.unique(np.array(pairs, dtype=np.int64))

    def _keys(self, rows) -> np.ndarray:
        """Rows of word numbers as byte strings that sort like the rows."""
        table = np.array(rows, dtype=">u4").reshape(-1, self.window)
        return np.ascontiguousarray(table).view(f"S{4 * self.window}").ravel()

    def starts(self, ids: np.ndarray) -> np.ndarray:
        """Positions whose first one or two words start a benchmark suffix."""
        known = np.flatnonzero(ids[: len(ids) - self.window])
        first = ids[known].astype(np.int64)
        can = np.isin(first, self.singles)
        if len(self.pairs):
            pair = first << 32 | ids[known + 1]
            spot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            can |= self.pairs[spot] == pair
        return known[can]

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and key numbers of every occurrence of a key in a shard's words."""
        starts = self.starts(ids)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = self._keys(ids[starts[:, None] + np.arange(self.window)])
        order = np.argsort(keys, kind="stable")
        array, keys = starts[order], keys[order]
        low = np.searchsorted(keys, self.low, "left")
        high = np.searchsorted(keys, self.high, "right")
        hit = np.flatnonzero(high > low)
        counts = (high - low)[hit]
        which = np.repeat(hit, counts)
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return array[low[which] + inside], which

    def shard(self, texts: list[str | None]) -> pd.DataFrame:
        """What each text of a shard shares with the benchmark."""
        lookup, gap = self.numbers.get, [0] * self.window
        parts, sizes = [], []
        for text in texts:
            words = words_of(text)
            sizes.append(len(words))
            parts += [np.fromiter(map(lookup, words, repeat(0)), np.int64, len(words)), gap]
        ids = np.concatenate(parts).astype(np.int64)
        begins = np.cumsum([0, *(n + self.window for n in sizes[:-1])])
        at, which = self.search(ids)
        out = {
            "n_words": sizes,
            "spans": [[] for _ in texts],
            "items": [[] for _ in texts],
            "matches": [[] for _ in texts],
        }
        docs = np.searchsorted(begins, at, "right") - 1
        order = np.argsort(docs, kind="stable")
        at, which, docs = at[order], which[order], docs[order]
        for part in np.split(np.arange(len(docs)), np.flatnonzero(np.diff(docs)) + 1):
            if len(part):
                doc = docs[part[0]]
                place = at[part] - begins[doc]
                out["spans"][doc] = _merged(place, self.lengths[which[part]])
                out["matches"][doc] = self._runs(place, which[part])
                out["items"][doc] = sorted({m["item"] for m in out["matches"][doc]})
        return pd.DataFrame(out)

    def _runs(self, place: np.ndarray, which: np.ndarray) -> list[dict]:
        """The longest matches: occurrences one after another on the same diagonal, joined."""
        hits = sorted(
            (item, at - start, at, int(self.lengths[key]))
            for at, key in zip(place.tolist(), which.tolist())
            for item, start in self.sources[key]
        )
        out: list[list[int]] = []
        for item, diagonal, at, length in hits:
            if out and out[-1][:2] == [item, diagonal] and at <= out[-1][3] - length + 1:
                out[-1][3] = max(out[-1][3], at + length)
            else:
                out.append([item, diagonal, at, at + length])
        return [
            {"item": self.names[item], "item_start": at - diagonal, "start": at, "length": end - at}
            for item, diagonal, at, end in out
        ]


def _merged(place: np.ndarray, length: np.ndarray) -> list[dict]:
    """The words hit, as spans that do not touch."""
    out: list[list[int]] = []
    for start, end in sorted(zip(place.tolist(), (place + length).tolist())):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [{"start": start, "length": end - start} for start, end in out]


def _searcher(shared):
    @F.pandas_udf(FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        suffixes = shared.value
        for texts in batches:
            yield suffixes.shard(list(texts))

    return search


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about ``block_chars`` characters, one at a time on the driver."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // block_chars))
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
        yield [(row.item, row.text) for row in part.collect()]


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    into: str,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with a struct column ``into``: what each text shares with the benchmark.

    Its fields are ``n_words``; ``spans`` of hit words, which may touch; ``items`` that occur
    (ids as text, an item without id as an empty text); and ``matches``, the longest verbatim
    matches by item. Null and empty texts have no words and match nothing; so do items
    without words. Repeated documents and items are judged alike.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.where(F.col(item_text).isNotNull()).select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.col(item_text).alias("text"),
    )
    merged = None
    for k, block in enumerate(_blocks(items, block_chars)):
        shared = spark.sparkContext.broadcast(TestSuffixes(block, window))
        if k:
            docs = stored(docs, "suffix_block")
        found = _searcher(shared)(F.col(text))
        docs = docs.withColumn(into, found if merged is None else _united(F.col(into), found))
        merged = into
    return docs


def _united(one: Column, two: Column) -> Column:
    """The findings of two blocks as one."""
    both = {name: F.concat(one[name], two[name]) for name in ("spans", "matches")}
    return F.struct(
        one["n_words"].alias("n_words"),
        both["spans"].alias("spans"),
        F.array_union(one["items"], two["items"]).alias("items"),
        both["matches"].alias("matches"),
    )


def words_hit(spans: Column) -> Column:
    """How many words lie in at least one span."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))

    def add(seen: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        new = F.greatest(end - F.greatest(span["start"], seen["end"]), F.lit(0))
        return F.struct(F.greatest(seen["end"], end).alias("end"), (seen["hit"] + new).alias("hit"))

    return F.aggregate(F.array_sort(spans), start, add)["hit"]


def judge(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: words, words hit, occurring items and their digest, and the verdict."""
    found = with_matches(docs.select(key, "text"), benchmark, "found")
    n_hit = words_hit(F.col("found.spans"))
    items = F.array_join(F.array_sort("found.items"), ",")
    return found.select(
        key,
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_only(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those in which a benchmark window occurs."""
    into = free_name(docs, "_suffix_found")
    found = with_matches(docs, benchmark, into)
    return found.where(F.size(F.col(into)["items"]) == 0).drop(into)


ORACLE = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
asked AS (SELECT DISTINCT item, k, array_to_string(words[p:p + k - 1], ' ') AS said
    FROM (SELECT item, words, least(10, len(words)) AS k, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS p
          FROM items WHERE len(words) > 0)),
windows AS (SELECT r, k, p, array_to_string(words[p:p + k - 1], ' ') AS said
    FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 2)) AS p
          FROM texts, (SELECT DISTINCT k FROM asked) WHERE len(words) >= k)),
found AS (SELECT r, k, p, item FROM windows JOIN asked USING (k, said)),
hits AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS place FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
