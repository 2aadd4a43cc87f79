"""Prefix trie of conversations: union-find over sorted neighbours, longest common prefix first.

Equal conversations are one class. Classes are put in the order of their turns' digests, so a
trie node is a run of neighbours, and the common prefix of two neighbours (the edge between
them) says at which depth their runs meet. The order is cut into blocks of ``BLOCK`` classes.
In a block the edges go by descending depth: a component first climbs to the edge's depth,
leaving a node at every step, and the merge of two components makes the branching node there.
What a component carries (members, leaves, sums of bytes) adds up in a merge.

A node whose run reaches a block's border is a piece. A block knows the classes on either side of
it, so it knows which of its components go on, to which depth. The pieces are the contracted
forest: at most two at each depth and block. Those of one depth that touch across borders are
merged into one node; nothing else leaves its block, and no node's members meet in one task.

Rows without ``conv_id`` belong to no conversation. Rows go by turn, null first, and by the
digest of role and text where turns are equal; null roles and texts are empty; repeated rows
are turns of their own. ``c % 5`` has the sign of ``c``. An empty table has no nodes. A turn's
identity is the SHA-256 of its role and text. A conversation's digests, 32 bytes a turn, are
one value; its texts never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import crc32_of, numbered, stored

# Classes per block: what one task holds at once.
BLOCK = 20_000
DIGEST = 32
GROUP = 5
HEADS = 9
# Ids of a class go into one text per so many consecutive numbers.
ID_RANGE = 1 << 16


def turns_of(rows: DataFrame) -> DataFrame:
    """``conv``, ``place`` (from 0), ``digest`` and ``bytes`` (of the text) for every turn."""
    role, text = (F.coalesce(rows[c].cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    known = rows.where(rows.conv_id.isNotNull()).select(
        rows.conv_id.alias("conv"), rows.turn.alias("turn"),
        F.unhex(F.sha2(said, 256)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )
    ordered = numbered(known, ["conv", "turn", "digest"], "trie_turns")
    starts = ordered.groupBy("conv").agg(F.min("at").alias("start"))
    placed = ordered.join(starts, "conv")
    return stored(placed.select("conv", (F.col("at") - F.col("start")).alias("place"), "digest", "bytes"), "trie_placed")


def rebuilt(rows: DataFrame) -> DataFrame:
    """Every ``conv`` with its own turns behind a head taken from its group's first conversation.

    One row per conversation: ``turns``, its digests and bytes in order; none, if it has no turn.
    """
    turns = turns_of(rows)
    convs = turns.select("conv").distinct().withColumn("head", crc32_of(F.col("conv")) % HEADS)
    base = F.col("conv") - F.col("conv") % GROUP
    first = turns.where((F.col("conv") % GROUP == 0) & (F.col("place") < HEADS)).withColumnRenamed("conv", "base")
    heads = convs.withColumn("base", base).join(first, "base").where("place < head")
    own = turns.where(F.col("place") >= crc32_of(F.col("conv")) % HEADS)
    parts = [heads.select("conv", F.lit(0).alias("part"), "place", "digest", "bytes"),
             own.select("conv", F.lit(1).alias("part"), "place", "digest", "bytes")]
    none = convs.select("conv", *[F.lit(None).cast(t).alias(c) for c, t in
                                  (("part", "int"), ("place", "long"), ("digest", "binary"), ("bytes", "long"))])
    every = parts[0].union(parts[1]).union(none)
    turn = F.when(F.col("digest").isNotNull(), F.struct("part", "place", "digest", "bytes"))
    return every.groupBy("conv").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _flat(digests: pd.Series) -> pd.Series:
    return digests.map(lambda row: b"".join(row))


def classes_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal conversations once, in order: ``key`` (digests end to end), ``weights``, ``members``
    and the ``least`` id; and beside them every conversation with its key."""
    key = F.pandas_udf(_flat, "binary")(F.col("turns.digest"))
    flat = stored(conversations.select("conv", key.alias("key"), F.col("turns.bytes").alias("weights")), "trie_flat")
    members = F.count(F.lit(1)).alias("members")
    grouped = flat.groupBy("key").agg(F.min("conv").alias("least"), members, F.any_value("weights").alias("weights"))
    return numbered(grouped, ["key"], "trie_classes"), flat


def blocks_of(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Classes by ``block``; the classes on either side of a border go to both of its blocks."""
    own, place = F.expr(f"at div {block}L"), F.col("at") % block
    into = F.array(own, F.when(place == 0, own - 1), F.when(place == block - 1, own + 1))
    return classes.withColumn("block", F.explode(F.array_compact(into))).where("block >= 0")


@dataclass
class _Component:
    """A run of classes below the node at ``depth`` that is next to be settled."""

    lo: int
    hi: int
    depth: int
    members: int
    least: int
    leaves: int
    children: int = 0
    all_bytes: int = 0  # bytes of every member's turns from here down
    new_bytes: int = 0  # bytes of every node's turn from here down
    ends: int | None = None  # the class that ends at this depth, by its least id
    below: list[int] = field(default_factory=list)  # rows of the nodes just below


NODES = (
    "depth int, lo long, least long, members long, children long, leaves long, all_bytes long, new_bytes long, "
    "ends long, parent long, parent_lo long, from_left boolean, to_right boolean"
)
_NODE_COLUMNS = [c.split()[0] for c in NODES.split(", ")]


def _common(a: bytes, b: bytes) -> int:
    """The number of digests that two keys share at their start."""
    most = min(len(a), len(b)) // DIGEST
    same = 0
    while same < most and a[same * DIGEST : (same + 1) * DIGEST] == b[same * DIGEST : (same + 1) * DIGEST]:
        same += 1
    return same


class _Forest:
    """Union-find over the classes of one block."""

    def __init__(self, rows: pd.DataFrame, before: bytes | None, after: bytes | None) -> None:
        keys = rows["key"].tolist()
        self.first_at = int(rows["at"].iloc[0])
        self.weights = rows["weights"].tolist()
        ring = [before, *keys, after]
        # edges[i] is the common depth of class i and the one before; -1 where there is none.
        self.edges = [-1 if a is None or b is None else _common(a, b) for a, b in zip(ring, ring[1:])]
        self.last = len(keys) - 1
        self.up = list(range(len(keys)))
        self.out: list[list] = []
        self.runs = []
        for k, (key, least, members) in enumerate(zip(keys, rows["least"].tolist(), rows["members"].tolist())):
            depth = len(key) // DIGEST
            leaf = int(self.edges[k + 1] < depth)
            self.runs.append(_Component(k, k, depth, members, least, leaf, ends=least))

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = k = self.up[self.up[k]]
        return k

    def settle(self, run: _Component) -> None:
        """The node at the run's depth is complete in this block; go one step up."""
        depth = run.depth
        from_left = run.lo == 0 and self.edges[0] >= depth
        to_right = run.hi == self.last and self.edges[-1] >= depth
        weight = int(self.weights[run.lo][depth - 1]) if depth else 0
        run.all_bytes += run.members * weight
        run.new_bytes += 0 if from_left else weight  # a node counts once, where its run begins
        lo, is_piece = self.first_at + run.lo, from_left or to_right
        for row in run.below:
            self.out[row][9:11] = [None, lo] if is_piece else [run.least, None]
        self.out.append([depth, lo, run.least, run.members, run.children, run.leaves, run.all_bytes,
                         run.new_bytes, run.ends, None, None, from_left, to_right])
        run.below, run.children, run.ends = [len(self.out) - 1], int(not from_left), None
        run.depth -= 1

    def merge(self, left: int, right: int, depth: int) -> None:
        a, b = self.root(left), self.root(right)
        one, two = self.runs[a], self.runs[b]
        for run in (one, two):
            while run.depth > depth:
                self.settle(run)
        self.up[b] = a
        self.runs[a] = _Component(
            one.lo, two.hi, depth, one.members + two.members, min(one.least, two.least), one.leaves + two.leaves,
            one.children + two.children, one.all_bytes + two.all_bytes, one.new_bytes + two.new_bytes,
            two.ends if one.ends is None else one.ends, one.below + two.below,
        )

    def nodes(self) -> pd.DataFrame:
        inner = np.array(self.edges[1:-1], dtype=np.int64)
        for k in np.argsort(-inner, kind="stable").tolist():
            self.merge(k, k + 1, int(inner[k]))
        run = self.runs[self.root(0)]
        while run.depth >= 0:
            self.settle(run)
        return pd.DataFrame(self.out, columns=_NODE_COLUMNS).astype({c: "Int64" for c in ("ends", "parent", "parent_lo")})


def _block_nodes(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes and pieces of one block, borders included."""
    (number, size) = key
    rows = rows.sort_values("at")
    mine = rows["at"] // size == number
    before, after = rows[rows["at"] < number * size]["key"], rows[rows["at"] >= (number + 1) * size]["key"]
    if not mine.any():
        return pd.DataFrame([], columns=_NODE_COLUMNS)
    edge = lambda side: bytes(side.iloc[0]) if len(side) else None
    return _Forest(rows[mine], edge(before), edge(after)).nodes()


def nodes_of(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every trie node: ``depth``, ``least``, ``parent`` and its sums."""
    rows = blocks_of(classes, block).withColumn("size", F.lit(block))
    found = stored(rows.groupBy("block", "size").applyInPandas(_block_nodes, NODES), "trie_nodes")
    is_piece = F.col("from_left") | F.col("to_right")
    pieces = found.where(is_piece)
    # Pieces of one depth in order: one that nothing leads into from the left begins a node.
    in_order = Window.partitionBy("depth").orderBy("lo")
    run = F.sum((~F.col("from_left")).cast("long")).over(in_order)
    pieces = stored(pieces.withColumn("run", run), "trie_pieces")
    totals = [F.sum(c).alias(c) for c in ("members", "children", "leaves", "all_bytes", "new_bytes")]
    merged = pieces.groupBy("depth", "run").agg(
        F.min("least").alias("least"), *totals, F.max("ends").alias("ends"), F.min("parent_lo").alias("parent_lo")
    )
    merged = stored(merged, "trie_merged")
    named = pieces.select("depth", "run", "lo").join(merged.select("depth", "run", "least"), ["depth", "run"])
    named = named.select((F.col("depth") + 1).alias("depth"), F.col("lo").alias("parent_lo"), F.col("least").alias("over"))
    columns = ["depth", "least", "members", "children", "leaves", "all_bytes", "new_bytes", "ends", "parent", "parent_lo"]
    every = found.where(~is_piece).select(columns).union(
        merged.withColumn("parent", F.lit(None).cast("long")).select(columns)
    )
    return every.join(named, ["depth", "parent_lo"], "left").withColumn("parent", F.coalesce("parent", "over"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each class's texts, which come sorted; only one text is held at a time."""
    ends, state = None, None
    for batch in batches:
        done = []
        for key, text in zip(batch["ends"].to_pylist(), batch["ids"].to_pylist()):
            if state is not None and key == ends:
                state.update(b",")
            else:
                if state is not None:
                    done.append((ends, state.hexdigest()))
                ends, state = key, hashlib.sha256()
            state.update(text.encode())
        yield pa.record_batch([pa.array([k for k, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())],
                              names=["ends", "ends_sha256"])
    if state is not None:
        yield pa.record_batch([pa.array([ends], pa.int64()), pa.array([state.hexdigest()])], names=["ends", "ends_sha256"])


def id_digests(flat: DataFrame, classes: DataFrame) -> DataFrame:
    """``ends`` (a class by its least id) and the digest of its members' ids, ascending.

    A SHA-256 has to see its text in order. Ids are joined by ranges first, in many tasks; the
    texts of a class then pass through one task, one at a time.
    """
    members = flat.join(classes.select("key", F.col("least").alias("ends")), "key")
    span = F.floor(F.col("conv") / ID_RANGE)
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    texts = members.groupBy("ends", span.alias("span")).agg(F.array_join(ids, ",").alias("ids"))
    ordered = texts.repartition("ends").sortWithinPartitions("ends", "span").select("ends", "ids")
    return ordered.mapInArrow(_digests, "ends long, ends_sha256 string")


def trie(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node."""
    classes, flat = classes_of(rebuilt(rows))
    classes = stored(classes, "trie_order")
    nodes = nodes_of(classes, block).join(id_digests(flat, classes), "ends", "left")
    return nodes.select(
        F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.col("parent").alias("parent_conv_id"), F.col("members").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("all_bytes") - F.col("new_bytes")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


ORACLE = """
WITH RECURSIVE
bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc(id, digit, c) AS (
  SELECT DISTINCT conv_id, 1, 4294967295 FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT id, digit + 1, xor(v, c >> 8) FROM crc JOIN bits ON k = 8 AND i = xor(c, unicode(substr(id::VARCHAR, digit, 1))) & 255
  WHERE digit <= length(id::VARCHAR)),
convs AS (SELECT id, xor(c, 4294967295) % 9 AS head FROM crc WHERE digit = length(id::VARCHAR) + 1),
said AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS w,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) - 1 AS place FROM said),
parts AS (
  SELECT id, 0 AS part, place, h, w FROM convs JOIN own ON conv_id = id - id % 5 AND place < head
  UNION ALL SELECT id, 1, place, h, w FROM convs JOIN own ON conv_id = id AND place >= head),
turns AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY part, place) AS depth FROM parts),
paths(id, depth, node, w) AS (
  SELECT id, 0, '', 0 FROM convs
  UNION ALL SELECT p.id, t.depth, sha256(node || h), t.w FROM paths p JOIN turns t ON t.id = p.id AND t.depth = p.depth + 1),
nodes AS (
  SELECT depth, node, min(id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS gain FROM paths GROUP BY ALL),
ends AS (
  SELECT node, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids
  FROM (SELECT id, node, row_number() OVER (PARTITION BY id ORDER BY depth DESC) AS r FROM paths) WHERE r = 1 GROUP BY node),
kids AS (
  SELECT p.depth, p.node, count(*) AS n FROM nodes n JOIN paths p ON p.id = n.conv_id AND p.depth = n.depth - 1 GROUP BY ALL),
sums AS (
  SELECT p.depth, p.node, sum(n.gain)::BIGINT AS saved_tokens, count(*) FILTER (k.n IS NULL) AS n_leaves
  FROM nodes n JOIN paths p ON p.id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node
  GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
  s.n_leaves, s.saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums s ON s.depth = n.depth AND s.node = n.node
LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node
LEFT JOIN ends e ON e.node = n.node
LEFT JOIN paths p ON p.id = n.conv_id AND p.depth = n.depth - 1
LEFT JOIN nodes u ON u.depth = p.depth AND u.node = p.node
"""
