"""URL filters: pattern rules fetched by their rarest literal token.

A rule names the literal tokens every matching URL must contain whole. The rarest of them,
by the counts of the URLs at hand, is its index entry; rules without one stand under the empty
token, which every URL has. URLs are cut into tokens, tokens fetch candidate rules by an
ordinary join, and only fetched rules run their regular expression. All of it is built-in
expressions; each different URL is judged once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import ascii_lower

NO_TOKEN = ""


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host and path; higher ``rank`` wins, then the longer name."""

    name: str
    action: str
    pattern: str
    literals: tuple[str, ...]
    rank: int = 0


def host_path_rule(name: str, action: str) -> Rule:
    """A rule ``host/path`` for a host and its subdomains and all paths that start so."""
    host, slash, path = name.partition("/")
    whole = re.sub(r"[A-Za-z0-9]+$", "", slash + path)  # a last part may go on in the URL
    tokens = re.findall(r"[a-z0-9]+", f"{host} {whole}".lower())
    return Rule(name, action, rf"^(?:[^/]*\.)?\Q{host}{slash}{path}\E", tuple(tokens), rank=1)


def host_words_rule(name: str, action: str, *words: str) -> Rule:
    """A rule for hosts that contain these words one after another, as whole tokens."""
    inner = "[^a-z0-9/]+".join(words)
    pattern = rf"^(?:[^/]*[^a-z0-9/])?{inner}(?:[^a-z0-9/][^/]*)?(?:/|$)"
    return Rule(name, action, pattern, words)


SITE_RULES = (
    host_path_rule("net/", "block"),
    host_path_rule("example.net/en/", "allow"),
    host_path_rule("example.com/de/", "block"),
    host_path_rule("org/fr/", "allow"),
)
WORD_RULES = tuple(
    host_words_rule("-".join(words), "block", *words)
    for words in (
        ("adult",), ("porn",), ("xxx",), ("casino",), ("poker",), ("viagra",), ("pharmacy",), ("warez",),
        ("cheap", "pills"), ("free", "bets"), ("spam", "farm"), ("payday", "loans"), ("doubleclick",), ("adserver",),
    )
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _tokens(place: Column) -> Column:
    """The different tokens of a URL, the empty one among them."""
    tokens = F.split(ascii_lower(place), "[^a-z0-9]+")
    return F.array_union(F.array(F.lit(NO_TOKEN)), tokens)


def _small(spark, rows: list[dict], schema: pa.Schema) -> DataFrame:
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def index_rules(tokens: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Each rule under its rarest literal. Counts come back for the rules' own tokens only."""
    spark = tokens.sparkSession
    literals = sorted({token for rule in rules for token in rule.literals})
    asked = _small(spark, [{"token": t} for t in literals], pa.schema({"token": pa.string()}))
    counts = tokens.join(asked, "token").groupBy("token").count()
    seen = {row.token: row["count"] for row in counts.collect()}
    entries = [
        {
            "token": min(rule.literals, key=lambda t: (seen.get(t, 0), t), default=NO_TOKEN),
            "name": rule.name,
            "action": rule.action,
            "pattern": rule.pattern,
            "rank": rule.rank,
        }
        for rule in rules
    ]
    kinds = {k: pa.string() for k in ("token", "name", "action", "pattern")} | {"rank": pa.int32()}
    return _small(spark, entries, pa.schema(kinds))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = SITE_RULES + WORD_RULES,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``matched``, ``verdict`` per row of ``pages``.

    ``matched`` is the winning rule, ``rule`` the same if it is of rank 1, a site rule. Null
    URLs and those without ``://`` have empty host and path and get the default unless a rule
    without literals fits them. Repeated rows stay; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(key, host.alias("host"), path.alias("path"))
    rows = rows.withColumn("place", F.concat("host", "path"))
    tokens = rows.select("place").distinct().select("place", F.explode(_tokens(F.col("place"))).alias("token"))
    index = index_rules(tokens, rules)
    fits = tokens.join(index, "token").where(F.rlike("place", F.col("pattern")))
    order = F.struct("rank", F.length("name").alias("n"), "name", "action")
    best = fits.groupBy("place").agg(F.max(order).alias("best"))
    return rows.join(best, "place", "left").select(
        key,
        "host",
        "path",
        F.when(F.col("best.rank") == 1, F.col("best.name")).alias("rule"),
        F.col("best.name").alias("matched"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql(rules: Sequence[Rule]) -> str:
    values = ", ".join(
        f"({_quoted(r.name)}, {_quoted(r.action)}, {_quoted(r.pattern)}, {r.rank})" for r in rules
    )
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH rules(name, action, pattern, rank) AS (VALUES {values}),
    cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
    parts AS (SELECT page_id, {lower.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    places AS (SELECT DISTINCT host || path AS place FROM parts),
    best AS (SELECT place, max({{'rank': rank, 'n': length(name), 'name': name, 'action': action}}) AS b
             FROM places JOIN rules ON regexp_matches(place, pattern) GROUP BY place)
    SELECT page_id, host, path, CASE WHEN b.rank = 1 THEN b.name END AS rule, b.name AS matched,
           coalesce(b.action, 'allow') AS verdict
    FROM parts LEFT JOIN best ON host || path = place
    """


ORACLE = _sql(SITE_RULES + WORD_RULES)
