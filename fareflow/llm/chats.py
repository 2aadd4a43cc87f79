"""Reply trees: root-to-leaf paths by iterative self-joins, ranked, each formatted as one chat.

Every message knows its parent. Jumps start as single steps and double by joining with
themselves, so a path of d messages takes log2(d) rounds, each a pair of joins over ids only.
Branches are ranked by the scores summed on the way; the messages of the chosen ones come
from the same jumps, and texts join once, at the end. A conversation's formatted text is a single value, so all its turns
meet in one row by nature; nothing else is gathered.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import small_batches, stored

# A turn is <s>[ROLE:name]\ntext</s>\n. Inside a text or name every start of a control string
# gets a backslash after its first character, and one more where backslashes stand already.
_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|ROLE:|\|)")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|ROLE:|\|)")
_TURN = re.compile(r"<s>\[ROLE:([^\]]*)\]\n(.*?)</s>\n", re.S)
LEARNED = "assistant"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The chat as one text, and the spans (code points) to learn from."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[ROLE:{quote(role, safe='')}]\n", escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "</s>\n"]
        at += len(head) + len(body) + 5
    return "".join(out), spans


def read_turns(chat: str) -> list[tuple[str, str]]:
    """The turns of a formatted chat."""
    return [(unquote(role), unescape(text)) for role, text in _TURN.findall(chat)]


def with_parents(rows: DataFrame, tree: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turn-by-turn conversations as reply trees of one branch.

    Rows go by turn; equal turns by role and text, nulls first. Null roles and texts are
    empty. The score of a message is the length of its text.
    """
    known = rows.select(
        tree,
        F.col(turn).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    node = F.row_number().over(Window.partitionBy(tree).orderBy("turn", "role", "text"))
    return known.select(
        F.col(tree).alias("tree"), node.cast("long").alias("node"), "role", "text",
        F.length("text").cast("double").alias("score"),
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


@dataclass
class Paths:
    """Root-to-leaf paths: ``leaves`` (``tree``, ``leaf``, ``total`` score, ``steps``) and the jumps.

    ``jumps[k]`` leads every message that has so many ancestors 2**k messages up.
    """

    leaves: DataFrame
    jumps: list[DataFrame]


def _same(tree: str, node: str) -> Column:
    return F.col("tree").eqNullSafe(F.col(tree)) & (F.col(node) == F.col("n"))


def root_to_leaf(messages: DataFrame) -> Paths:
    """Every path, named by its leaf.

    A parent that is not there makes its child a root. Messages that only lead into a cycle
    of parents have no root and no path. Repeated (tree, node) ids count once. A round touches
    only the messages whose jump or path has not reached its root.
    """
    nodes = messages.select("tree", "node", "parent", "score").dropDuplicates(["tree", "node"])
    here = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    linked = nodes.join(here, _same("t", "parent"), "left").select(
        "tree", "node", F.col("n").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("steps")
    )
    jumps = stored(linked, "jumps")
    parents = jumps.select(F.col("tree").alias("t"), F.col("up").alias("n")).where("n is not null")
    open_ = jumps.join(parents, _same("t", "node"), "left_anti").withColumnRenamed("node", "leaf")
    longest = jumps.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    levels, done, reach = [], [], 1
    while reach < 2 * longest:
        open_ = stored(open_, "paths")
        done.append(open_.where("up is null"))
        open_ = open_.where("up is not null")
        levels.append(jumps.where("up is not null"))
        if open_.isEmpty():
            break
        further = _led_on(levels[-1], jumps, "node").union(jumps.where("up is null"))
        open_, jumps = _led_on(open_, jumps, "leaf"), stored(further, "jumps")
        reach *= 2
    leaves = reduce(DataFrame.union, done) if done else open_
    return Paths(leaves.drop("up"), levels)


def _led_on(paths: DataFrame, jumps: DataFrame, end: str) -> DataFrame:
    """Paths that have not reached their root, each led on by the jump from its top."""
    ahead = jumps.select(
        F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("next"),
        F.col("total").alias("more"), F.col("steps").alias("further"),
    )
    return paths.join(ahead, _same("t", "up")).select(
        "tree", end, F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"),
        (F.col("steps") + F.col("further")).alias("steps"),
    )


def best_paths(paths: DataFrame, keep: int | None = 1) -> DataFrame:
    """Each tree's ``keep`` best leaves by mean score, ties to the smaller leaf; None keeps all."""
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("steps")), "leaf")
    ranked = paths.withColumn("branch", F.row_number().over(order))
    return ranked if keep is None else ranked.where(F.col("branch") <= keep)


def path_nodes(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """``tree``, ``branch``, ``node``, ``up_from_leaf`` for every message of the chosen paths.

    Each round doubles the known lower end of every path, so rows grow to the paths' own length.
    """
    known = chosen.select("tree", "branch", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up_from_leaf"))
    for k, level in enumerate(jumps):
        known = stored(known, "path_nodes")
        ahead = level.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("next"))
        found = known.join(ahead, _same("t", "node")).select(
            "tree", "branch", F.col("next").alias("node"), (F.col("up_from_leaf") + 2**k).alias("up_from_leaf")
        )
        known = known.union(found)
    return known


FORMATTED = "text string, loss array<struct<start: int, end: int>>"


def _formatted(turns: pd.Series) -> pd.DataFrame:
    done = [format_turns([(t["role"], t["text"]) for t in row]) for row in turns]
    spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
    return pd.DataFrame({"text": [text for text, _ in done], "loss": spans})


def format_trees(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """``tree``, ``branch``, ``text``, ``loss`` spans: each chosen path as one conversation."""
    small_batches(messages.sparkSession)
    messages = stored(messages, "messages")
    paths = root_to_leaf(messages)
    steps = path_nodes(best_paths(paths.leaves, keep), paths.jumps)
    texts = messages.dropDuplicates(["tree", "node"]).select(
        F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text"
    )
    turn = F.struct((-F.col("up_from_leaf")).alias("at"), "role", "text")
    turns = F.sort_array(F.collect_list(turn))
    chats = steps.join(texts, _same("t", "node")).groupBy("tree", "branch").agg(turns.alias("turns"))
    formatted = F.pandas_udf(_formatted, FORMATTED)("turns")
    return chats.select("tree", "branch", formatted.alias("chat")).select("tree", "branch", "chat.*")


READ_BACK = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(texts: pd.Series, losses: pd.Series) -> pd.DataFrame:
    rows = []
    for chat, loss in zip(texts, losses):
        turns = read_turns(chat)
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        learned = "".join(unescape(chat[span["start"] : span["end"]]) for span in loss)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, learned)]
        rows.append((len(turns), digests[0], len(learned), digests[1], len(chat)))
    return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def round_trip(rows: DataFrame) -> DataFrame:
    """Conversations formatted, written, read back and digested, one row each."""
    chats = stored(format_trees(with_parents(rows)), "chats")
    read = F.pandas_udf(_read_back, READ_BACK)("text", "loss")
    return chats.select(F.col("tree").alias("conv_id"), read.alias("r")).select("conv_id", "r.*")


ORACLE = r"""
WITH all_rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (
  SELECT *, length('<s>[ROLE:' || role || ']' || chr(10))
    + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|ROLE:|\|)', '\1\\\2\3', 'g')) + 5 AS n FROM all_rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""
