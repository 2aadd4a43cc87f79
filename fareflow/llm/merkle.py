"""Merkle manifest of a dataset: leaves, trees by source, one root, and a climb that checks each leaf.

The documents are put in order of source and key by ranges, so a hot source is many tasks.
Trees have runs of three. ``STRIDE`` levels are built at a time: a block is the 729 nodes below
one node six levels up, gathered by one bounded group, and yields for every child the siblings
on its way up. Each stored row links a child to its ancestor; the upper links stand once for
every bottom block, so whatever the height no link is asked for by more than 729 leaves.

The climb is one recursive query: every leaf starts from its own block's siblings and ascends
the stored links, appending siblings to its proof and folding the hash of its possibly
tampered text. The fold must end at the root unless the text was changed.

Null columns hash as ``-``; sources go null first, then bytewise; keys ascend, null first; rows
equal in source and key go by their leaf; repeated rows are leaves of their own. A row without
a key is never tampered with. An empty table has no rows. Columns beyond the five are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import crc32_of, numbered, setting, stored

RUN = 3
STRIDE = 6
BLOCK = RUN**STRIDE
# Blocks that Python holds at once.
BLOCKS_PER_BATCH = 32
# The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<before: binary, after: binary>>"
_BLOCK = f"node binary, steps array<{_STEPS}>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: dict[str, Column]) -> Column:
    """The 32 bytes that stand for one document."""
    return F.unhex(F.sha2(F.concat(*[_field(fields[name]) for name in FIELDS]), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text without line ends where the key's CRC-32 is even, else as it is."""
    return F.when(crc32_of(doc_id) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def _join(digests: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def _ways(children: list[bytes], is_top: bool) -> tuple[bytes, list[list[dict[str, bytes]]]]:
    """The node above a block, and every child's siblings level by level.

    Below the top every block climbs ``STRIDE`` levels, even a single node; at the top the
    climb ends with one node.
    """
    levels = [children]
    while len(levels) <= STRIDE and not (is_top and len(levels[-1]) == 1):
        last = levels[-1]
        levels.append([_join(last[k : k + RUN]) for k in range(0, len(last), RUN)])
    ways = []
    for at in range(len(children)):
        way = []
        for level in levels[:-1]:
            first = at // RUN * RUN
            around = {"before": b"".join(level[first:at]), "after": b"".join(level[at + 1 : first + RUN])}
            way.append(around)
            at //= RUN
        ways.append(way)
    return levels[-1][0], ways


def _block(children: pd.Series, is_top: pd.Series) -> pd.DataFrame:
    done = [_ways([bytes(d) for d in row], top) for row, top in zip(children, is_top)]
    return pd.DataFrame({"node": [node for node, _ in done], "steps": [ways for _, ways in done]})


def _left(stage: int) -> Column:
    """How many nodes a tree of ``size`` leaves has left after so many strides."""
    return F.ceil(F.col("size") / F.lit(float(BLOCK**stage)))


def _over(place: str, stage: int) -> Column:
    """The first leaf below the node that stands over ``place`` after so many strides."""
    width = BLOCK**stage
    return F.expr(f"first + ({place} - first) div {width}L * {width}L")


def _gathered(nodes: DataFrame, stage: int, kept: list[str], name: str) -> DataFrame:
    """Each block of nodes with the node above it and its children's ways there."""
    child = F.struct("at", "digest", *kept)
    blocks = nodes.groupBy("first", "size", _over("at", stage + 1).alias("block")).agg(
        F.sort_array(F.collect_list(child)).alias("children")
    )
    built = F.pandas_udf(_block, _BLOCK)(F.col("children.digest"), _left(stage) <= BLOCK)
    with setting(nodes.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCKS_PER_BATCH)):
        return stored(blocks.withColumn("built", built), f"{name}_{stage}")


def _ways_of(level: DataFrame, *more: str) -> DataFrame:
    """A row for every child of a level's blocks: the child and its ``steps``."""
    child = F.explode(F.arrays_zip(F.col("children").alias("row"), F.col("built.steps").alias("steps")))
    return level.select(*more, child.alias("c")).select(*more, "c.row.*", "c.steps")


def _nodes_of(level: DataFrame) -> DataFrame:
    return level.select(F.col("block").alias("at"), "first", "size", F.col("built.node").alias("digest"))


@dataclass
class Trees:
    """``low``: the leaves, each with its block and the siblings up to the node over it.
    ``blocks``: every block with its tree. ``links``: what leads on from a block, by ``rise``,
    the strides behind it. ``tops``: the roots by their tree's first place."""

    low: DataFrame
    blocks: DataFrame
    links: DataFrame
    tops: DataFrame
    strides: int


def grow(leaves: DataFrame, kept: list[str], name: str) -> Trees:
    """Trees over ``at`` (the leaf's place), ``first`` (its tree's first place), ``size`` (its
    tree's leaves) and ``digest``."""
    widest = leaves.agg(F.max("size")).first()[0] or 0
    level = _gathered(leaves, 0, kept, name)
    low = _ways_of(level, "block", "first")
    nodes = _nodes_of(level)
    blocks = nodes.select(F.col("at").alias("block"), "first", "size")
    tops, links, stage = [nodes.where(_left(1) <= 1)], [], 1
    while BLOCK**stage < widest:
        level = _gathered(nodes.where(_left(stage) > 1), stage, [], name)
        reached = blocks.where(_left(stage) > 1).select("block", _over("block", stage).alias("at"))
        ways = _ways_of(level).select("at", "steps")
        links.append(reached.join(ways, "at").select("block", F.lit(stage).alias("rise"), "steps"))
        nodes = _nodes_of(level)
        stage += 1
        tops.append(nodes.where(_left(stage) <= 1))
    none = leaves.sparkSession.createDataFrame([], f"block long, rise int, steps {_STEPS}")
    tops = reduce(DataFrame.union, tops).select("first", F.col("digest").alias("top"))
    return Trees(low, blocks, reduce(DataFrame.union, links, none), tops, stage)


def _strides(most: int) -> Column:
    """How many strides the tree of a block has, at least one."""
    return reduce(lambda n, k: n + (_left(k) > 1).cast("int"), range(1, most), F.lit(1))


_FOLD = "(h, s) -> unhex(sha2(lower(hex(concat(s.before, h, s.after))), 256))"
_APPEND = "(p, s) -> concat(p, s.before, s.after)"
# A link to the root carries its leaf's subroot; that ends the climb.
CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT doc_id, digest AS leaf, block, 1 AS rise,
    aggregate(steps, X'', {_APPEND}) AS proof, aggregate(steps, changed, {_FOLD}) AS folded, subroot
  FROM {{leaves}}
  UNION ALL
  SELECT doc_id, leaf, climb.block, climb.rise + 1,
    aggregate(steps, proof, {_APPEND}), aggregate(steps, folded, {_FOLD}), links.subroot
  FROM climb JOIN {{links}} AS links ON climb.block = links.block AND climb.rise = links.rise)
SELECT * FROM climb WHERE subroot IS NOT NULL
"""


def _links(by_source: Trees, whole: Trees, ranks: DataFrame) -> DataFrame:
    """Every block's links in one count of ``rise``: through its source's tree, then over all sources."""
    first = ranks.select(F.col("at").alias("rank"), "first", F.col("top").alias("subroot"))
    entry = by_source.blocks.withColumn("own", _strides(by_source.strides)).join(first, "first")
    entry = entry.select(F.col("block").alias("bottom"), "own", "rank", "subroot")
    on = whole.low.select(F.col("at").alias("rank"), "block", "steps")
    step = stored(entry.join(on, "rank"), "merkle_entries")

    def of(rows: DataFrame, rise: Column, last: bool) -> DataFrame:
        subroot = F.col("subroot") if last else F.lit(None).cast("binary")
        return rows.select(F.col("bottom").alias("block"), rise.alias("rise"), "steps", subroot.alias("subroot"))

    links = by_source.links.withColumn("subroot", F.lit(None).cast("binary"))
    links = links.unionByName(of(step, F.col("own"), whole.strides == 1))
    for rise in range(1, whole.strides):
        further = step.drop("steps").join(whole.links.where(F.col("rise") == rise).drop("rise"), "block")
        links = links.unionByName(of(further, F.col("own") + rise, rise == whole.strides - 1))
    return links


def manifest(docs: DataFrame) -> DataFrame:
    """Every document's leaf, subroot, root, proof and the verdict on its tampered text."""
    spark = docs.sparkSession
    fields = {name: docs[name] for name in FIELDS}
    changed = fields | {"text": tampered(docs.doc_id, docs.text)}
    rows = docs.select(
        fields["doc_id"].alias("doc_id"), fields["source"].alias("source"),
        leaf_hash(fields).alias("digest"), leaf_hash(changed).alias("changed"),
    )
    rows = numbered(rows, ["source", "doc_id", "digest"], "merkle_leaves")
    trees = rows.groupBy(F.col("source").alias("tree")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("size")
    )
    trees = stored(trees, "merkle_sources")
    leaves = rows.join(trees, F.col("source").eqNullSafe(F.col("tree"))).drop("source", "tree")
    by_source = grow(leaves, ["doc_id", "changed"], "merkle_source")
    ranks = numbered(by_source.tops, ["first"], "merkle_ranks")
    count = ranks.count()
    alone = F.lit(None).cast("binary")
    if count > 1:
        over = ranks.select(
            "at", F.lit(0).cast("long").alias("first"), F.lit(count).alias("size"), F.col("top").alias("digest")
        )
        whole = grow(over, [], "merkle_whole")
        root = whole.tops.first()
        links = _links(by_source, whole, ranks)
    else:
        root = ranks.first()
        only = F.lit(bytes(root.top) if root else b"")
        last = F.col("rise") == by_source.strides - 1
        links = by_source.links.withColumn("subroot", F.when(last, only))
        alone = only if by_source.strides == 1 else alone
    low = by_source.low.withColumn("subroot", alone)
    with setting(spark, "spark.sql.cteRecursionRowLimit", "-1"):
        climbed = stored(spark.sql(CLIMB, leaves=low, links=stored(links, "merkle_links")), "merkle_climb")
    top = F.lit(bytes(root.top) if root else b"")
    return climbed.select(
        "doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        hex_text(top).alias("root"), F.sha2(hex_text(F.col("proof")), 256).alias("proof_sha256"),
        hex_text(F.col("folded")).alias("folded_root"), (F.col("folded") == top).alias("verified"),
    )


ORACLE = """
WITH RECURSIVE
bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc(id, digit, c) AS (
  SELECT DISTINCT doc_id, 1, 4294967295 FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT id, digit + 1, xor(v, c >> 8) FROM crc JOIN bits ON k = 8 AND i = xor(c, unicode(substr(id::VARCHAR, digit, 1))) & 255
  WHERE digit <= length(id::VARCHAR)),
odd AS (SELECT id, xor(c, 4294967295) AS crc FROM crc WHERE digit = length(id::VARCHAR) + 1),
texts AS (
  SELECT doc_id, source, lang, n_chars, text,
    CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM documents LEFT JOIN odd ON id = doc_id),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS changed
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM texts)),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM hashed),
levels(tree, level, pos, h, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value(n + 2) // 3
  FROM levels WHERE n > 1 GROUP BY tree, pos // 3),
subroots AS (SELECT tree, h, level AS height FROM levels WHERE n = 1),
tops(level, pos, h, n) AS (
  SELECT 0, tree, h, count(*) OVER () FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value(n + 2) // 3
  FROM tops WHERE n > 1 GROUP BY pos // 3),
nodes AS (
  SELECT tree, level, pos, h FROM levels WHERE n > 1 UNION ALL SELECT NULL, level, pos, h FROM tops WHERE n > 1),
beside AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM nodes a JOIN nodes b ON a.tree IS NOT DISTINCT FROM b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  GROUP BY ALL),
climb(leaf_tree, leaf_pos, tree, level, pos, proof, folded) AS (
  SELECT tree, pos, CASE WHEN height > 0 THEN tree END, 0, CASE WHEN height > 0 THEN pos ELSE tree END, '', changed
  FROM leaves JOIN subroots USING (tree)
  UNION ALL
  SELECT leaf_tree, leaf_pos, CASE WHEN c.level + 1 < coalesce(height, 99) THEN c.tree END,
    CASE WHEN c.level + 1 < coalesce(height, 99) OR c.tree IS NULL THEN c.level + 1 ELSE 0 END,
    CASE WHEN c.level + 1 < coalesce(height, 99) OR c.tree IS NULL THEN c.pos // 3 ELSE c.tree END,
    proof || before || after, sha256(before || folded || after)
  FROM climb c JOIN beside b ON b.tree IS NOT DISTINCT FROM c.tree AND b.level = c.level AND b.pos = c.pos
  LEFT JOIN subroots s ON s.tree = c.tree)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.h AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN (SELECT h, level FROM tops WHERE n = 1) t ON true
JOIN climb c ON c.leaf_tree = l.tree AND c.leaf_pos = l.pos AND c.tree IS NULL AND c.level = t.level
"""
