"""SimHash near-duplicates by a grid join over per-segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits, and each segment becomes its bit
count. Changing one bit moves one count by one, so the Manhattan distance of two count
vectors never exceeds the Hamming distance of the fingerprints. Fingerprints within three
bits therefore lie within distance one in at least one half of the vector: one half would
otherwise need two and the other two. The grid has one cell per half vector. Every
fingerprint owns its cell in either half and visits the cells one step up; of two
fingerprints one step apart the lower one visits the higher one's cell, so each candidate
pair meets. What meets is verified by the exact Hamming distance.

Only different fingerprints enter the grid; exact copies share one. Cells with many
fingerprints (a large group of near copies) are cut into blocks, and each pair of blocks
is compared in a task of its own that returns a spanning forest of the links it verified,
at most one row per fingerprint, never all pairs.
"""

from __future__ import annotations

from itertools import islice, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.common import free_name, small_batches, stored
from fareflow.llm.components import connected

SEED = 42
SHINGLE = 3
HASHES_AT_ONCE = 1 << 14
MAX_BITS = 3
EVEN_BITS = 0x5555555555555555
HALF = 0xFFFFFFFF
SEGMENTS_PER_HALF = 16
# Cells of more fingerprints than this go to block pairs instead of the plain join.
CELL_BLOCK = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint; zero for a text without words."""
    words = text.encode("utf-8").lower().split() if text else []  # bytes: A-Z, ASCII white space
    if not words:
        return 0
    size = min(shingle, len(words))
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(size))))
    total = len(words) - size + 1
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    ones = np.zeros(64, dtype=np.int64)
    while len(part := np.fromiter(islice(hashes, HASHES_AT_ONCE), dtype=np.uint64)):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))


def with_fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and its 64-bit ``fingerprint`` (signed), one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(key).alias("key"), F.pandas_udf(_fingerprint, T.LongType())(F.col(text)).alias("fingerprint"))


def hex_fingerprint(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def segment_counts(fingerprint: Column) -> Column:
    """The bit counts of the 32 two-bit segments, packed two bits each."""
    shifted = F.shiftrightunsigned(fingerprint, 1)
    both = fingerprint.bitwiseAND(shifted).bitwiseAND(F.lit(EVEN_BITS))
    one = fingerprint.bitwiseXOR(shifted).bitwiseAND(F.lit(EVEN_BITS))
    return F.shiftleft(both, 1).bitwiseOR(one)


def _halves(counts: Column) -> list[Column]:
    """The cell of either half; the second half's cells start above the first's."""
    low = counts.bitwiseAND(F.lit(HALF))
    high = F.shiftrightunsigned(counts, 32)
    return [low, high + F.lit(1 << 32)]


def _steps_up(cell: Column) -> list[Column]:
    """The cells one step up in one segment; null where the segment is full."""
    out = []
    for segment in range(SEGMENTS_PER_HALF):
        full = F.shiftright(cell, 2 * segment).bitwiseAND(F.lit(2)) != 0
        out.append(F.when(~full, cell + F.lit(1 << (2 * segment))))
    return out


def grid(prints: DataFrame) -> DataFrame:
    """``cell``, ``fp``, ``own``: every cell a fingerprint owns or visits."""
    halves = _halves(segment_counts(F.col("fp")))
    visits = F.array_compact(F.array(*[cell for half in halves for cell in _steps_up(half)]))
    cells = F.concat(
        F.transform(F.array(*halves), lambda c: F.struct(c.alias("cell"), F.lit(True).alias("own"))),
        F.transform(visits, lambda c: F.struct(c.alias("cell"), F.lit(False).alias("own"))),
    )
    return prints.select("fp", F.explode(cells).alias("at")).select("at.cell", "fp", "at.own")


def near_pairs(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that join every two of the different ``fp`` within three bits.

    In plain cells that is each pair once or twice; in cells of more than ``CELL_BLOCK``
    owners it is a spanning forest of each block's links, which connects the same rows.
    """
    cells = stored(grid(prints), "simhash_grid")
    large = cells.where("own").groupBy("cell").agg(F.count(F.lit(1)).alias("owners"))
    large = stored(large.where(F.col("owners") > CELL_BLOCK), "simhash_large")
    plain = cells.join(large, "cell", "left_anti")
    links = _plain_links(plain)
    if not large.isEmpty():
        links = links.union(_block_links(cells.join(large, "cell")))
    return links


def _plain_links(cells: DataFrame) -> DataFrame:
    owners = cells.where("own").select("cell", F.col("fp").alias("b"))
    met = cells.select("cell", F.col("fp").alias("a"), "own").join(owners, "cell")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    return met.where(close & (~F.col("own") | (F.col("a") < F.col("b")))).select("a", "b")


def _block_links(cells: DataFrame) -> DataFrame:
    """Large cells: every block of owners against every block of visitors and owners."""
    blocks = F.ceil(F.col("owners") / CELL_BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    owner_side = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda k: F.struct(mine.alias("o"), k.alias("p"), F.lit(True).alias("owner")),
    )
    probe_side = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda k: F.struct(k.alias("o"), mine.alias("p"), F.lit(False).alias("owner")),
    )
    both = F.when(F.col("own"), F.concat(owner_side, probe_side)).otherwise(probe_side)
    rows = cells.select("cell", "fp", F.explode(both).alias("at"))
    rows = rows.select("cell", "fp", "at.o", "at.p", "at.owner")
    return rows.groupBy("cell", "o", "p").applyInPandas(_forest, "a long, b long")


def _forest(block: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest of the verified links between a block's probes and owners."""
    owner = block["owner"].to_numpy()
    fp = block["fp"].to_numpy()
    owners, probes = np.unique(fp[owner]), np.unique(fp[~owner])
    label = {}
    edges = []

    def root(x: int) -> int:
        while label.setdefault(x, x) != x:
            label[x] = x = label[label[x]]
        return x

    for probe in probes:
        near = owners[np.bitwise_count((owners ^ probe).view(np.uint64)) <= MAX_BITS]
        for other in near[near != probe].tolist():
            one, two = root(int(probe)), root(other)
            if one != two:
                label[one] = two
                edges.append((int(probe), other))
    return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, one row per row of ``docs``.

    ``component_id`` is the smallest key reachable over links of at most three bits, itself
    included. Null keys are never the smallest unless a component has no other; null and
    empty texts have fingerprint zero and link like any other; repeated rows stay repeated.
    """
    grouped = _components(stored(with_fingerprint(docs, key, text), "simhash_prints"))
    return grouped.select(
        F.col("key").alias(key), hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def _components(prints: DataFrame) -> DataFrame:
    """``key``, ``fingerprint``, ``component_id`` and ``part``, the component by one of its fingerprints."""
    groups = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("key").alias("first"))
    groups = stored(groups, "simhash_groups")
    linked = connected(near_pairs(groups.select("fp")))
    known = linked.join(groups.withColumnRenamed("fp", "node"), "node")
    smallest = known.groupBy("root").agg(F.min("first").alias("least"))
    reach = linked.join(smallest, "root").select(F.col("node").alias("fp"), "least", "root")
    named = groups.join(reach, "fp", "left").select(
        "fp", F.coalesce("least", "first").alias("component_id"), F.coalesce("root", "fp").alias("part")
    )
    # Written first, so that nothing stands between the join and its shuffles: Spark then
    # splits the rows of a fingerprint that many copies share.
    named = stored(named, "simhash_named")
    return prints.join(named, prints.fingerprint == named.fp).select("key", "fingerprint", "component_id", "part")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without near copies: the document with the smallest key of each group stays.

    Of rows that share that key and lie in that group one stays, the same in every run. Rows that
    share a key but lie in different groups are different documents. Rows without a key cannot be
    told apart and all stay.
    """
    grouped = stored(_components(stored(with_fingerprint(docs, key, text), "simhash_prints")), "simhash_parts")
    first = grouped.where(F.col("key") == F.col("component_id"))
    spread = first.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    spread = stored(spread, "simhash_kept")
    mark = free_name(docs, "_simhash")
    own, print_, part = (f"{mark}_{name}" for name in ("key", "print", "part"))
    here = docs[key]
    whole = spread.where("low = high").select(F.col("key").alias(own))
    kept = _one_row(docs.join(whole, here == F.col(own), "left_semi"), key)
    kept = kept.unionByName(docs.where(here.isNull()))
    torn = spread.where("low <> high").select(F.col("key").alias(own))
    if torn.isEmpty():
        return kept
    # A key in several groups: only its rows are read for their fingerprints again.
    some = docs.join(torn, here == F.col(own), "left_semi")
    some = some.withColumn(mark, F.pandas_udf(_fingerprint, T.LongType())(F.col(text)))
    parts = first.select(
        F.col("key").alias(own), F.col("fingerprint").alias(print_), F.col("part").alias(part)
    ).distinct()
    met = some.join(parts, (F.col(key) == F.col(own)) & (F.col(mark) == F.col(print_)))
    return kept.unionByName(_one_row(met.drop(own, print_, mark), key, part).drop(part))


def _one_row(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of each key, the one with the smallest hash."""
    columns = rows.columns
    least = F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row")
    return rows.groupBy(*[F.col(k).alias(f"by_{n}") for n, k in enumerate(keys)]).agg(least).select("row.*")
