"""Personal data: base expressions give seeds, their contexts become patterns, patterns find more.

One pass over the texts finds the base spans and, beside them, candidates: tokens and groups of
digits that look like an identifier of some kind but fit no base expression. Every span and
candidate is an instance (its digits, or its lower-cased text) standing in three lexical
patterns: the two words before it, the word on either side, the two words behind it. Other
spans and candidates end the text around one.

Patterns and instances form a graph. In each of ``ROUNDS`` rounds a pattern's confidence for a
kind is the score its instances bring over all instances it holds plus one; seeds of the
kind score one, seeds of another nothing. An instance without a seed then scores what its best
confident pattern does. Patterns of at least ``MIN_CONFIDENCE`` that hold ``MIN_SEEDS`` different
seeds or more are confident. After the last round, candidates in a confident pattern become
spans of its kind. Scores are whole millionths, so no result hangs on the order of a sum.

Null and empty texts have no spans. Repeated rows keep their own spans; in the graph an
instance counts once in a pattern, however often texts repeat. Ties go to the kind listed
first. Only ``doc_id`` and ``text`` are read. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import small_batches, stored

# The kinds, in order.
KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MILLION = 1_000_000
MIN_CONFIDENCE = 800_000
MIN_SEEDS = 4
# A context word longer than this stands by its digest.
LONG_WORD = 40

# The base expressions. Runs are matched whole even where no span follows, so that
# none is looked at twice; an expression without its group found nothing.
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What may be an identifier though no base expression says so.
_NUMBER = re.compile(r"[0-9](?:[\x20().-]{0,2}[0-9])++")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]++")
_TOKEN_MARK = re.compile(r"[@:]|[\[(]at[\])]")
_MAIL_LIKE = re.compile(r"[A-Za-z0-9._%+-]+(?:@|[\[(]at[\])])[A-Za-z0-9][A-Za-z0-9.-]*")
_COLON_ADDRESS = re.compile(r"(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}")
_EDGE = "()[]{}<>\"'.,;:!?*$%&#|"
LONGEST_TOKEN = 254

SPAN = "start: int, stop: int, kind: int, may_be: int, instance: string, patterns: array<string>"
Span = tuple[int, int]


def _emails(text: str) -> Iterator[Span]:
    done = 0
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        domain = _EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _small(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _ips(text: str) -> Iterator[Span]:
    for match in _IP.finditer(text):
        if match.group(1) and all(map(_small, match.group().split("."))):
            yield match.span()


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for match in _CARD.finditer(text):
        digits = digits_of(match.group()) if match.end() - match.start() <= 2 * 19 else ""
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield match.span()


def _phones(text: str) -> Iterator[Span]:
    for match in _PHONE.finditer(text):
        if 9 <= len(digits_of(match.group())) <= 15:
            yield match.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of every base span, in order."""
    found = (_emails(text), _ips(text), _cards(text), _phones(text))
    return sorted((start, kind, stop) for kind, spans in enumerate(found) for start, stop in spans)


def _marked_tokens(text: str) -> Iterator[Span]:
    """Tokens around a mark that an address may hold, without the punctuation at their ends."""
    end = 0
    for mark in _TOKEN_MARK.finditer(text):
        if mark.start() < end:
            continue
        lead = text[end : mark.start()]
        start = end + max((lead.rfind(c) + 1 for c in " \t\n\v\f\r"), default=0)
        end = _TOKEN.match(text, mark.start()).end()
        token = text[start:end]
        first = start + len(token) - len(token.lstrip(_EDGE.replace(":", "")))
        yield first, max(first, start + len(token.rstrip(_EDGE)))


def _candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, stop, kinds it may be as bits) of what looks like an identifier and overlaps no base span."""
    shaped = []
    for match in _NUMBER.finditer(text):
        many = len(digits_of(match.group())) if match.end() - match.start() <= 64 else 0
        bits = (4 if 12 <= many <= 19 else 0) | (8 if 7 <= many <= 15 else 0)
        if bits:
            shaped.append((match.start(), match.end(), bits))
    for start, end in _marked_tokens(text):
        if not 5 <= end - start <= LONGEST_TOKEN:
            continue
        if _MAIL_LIKE.fullmatch(text, start, end):
            shaped.append((start, end, 1))
        elif _COLON_ADDRESS.fullmatch(text, start, end):
            shaped.append((start, end, 2))
    busy = sorted((a, b) for a, _, b in taken)
    kept, k, reach = [], 0, 0
    for start, end, bits in sorted(shaped):
        while k < len(busy) and busy[k][0] < end:
            reach, k = max(reach, busy[k][1]), k + 1
        if start >= reach:
            kept.append((start, end, bits))
            reach = end
    return kept


def _word(raw: str) -> str:
    word = raw.strip(_EDGE).lower() or raw
    word = re.sub(r"[0-9]", "0", word)
    return word if len(word) <= LONG_WORD else hashlib.md5(word.encode()).hexdigest()


def _context(words: list[str]) -> list[str]:
    return [_word(w) for w in words]


def patterns_between(before: str, behind: str, opens: str, closes: str) -> list[str]:
    """The lexical patterns of a span between two stretches of text.

    ``opens`` and ``closes`` stand for the words that a short stretch lacks.
    """
    far, near = _context([opens, opens, *before.rsplit(None, 2)][-2:])
    next_, after = _context([*behind.split(None, 2), closes, closes][:2])
    return [f"{far} {near} _", f"{near} _ {next_}", f"_ {next_} {after}"]


def _with_patterns(text: str, found: list[tuple[int, int]]) -> Iterator[list[str]]:
    """The patterns of each span, in order of start; the text beside a span ends at the next span."""
    starts, reach = [start for start, _ in found], 0
    for start, stop in found:
        k = bisect_left(starts, stop)
        end = starts[k] if k < len(starts) else len(text)
        opens, closes = "^" if reach == 0 else "<id>", "$" if end == len(text) else "<id>"
        yield patterns_between(text[reach:start], text[stop:end], opens, closes)
        reach = max(reach, stop)


def _instance(shown: str, is_number: bool) -> str:
    return digits_of(shown) if is_number else shown.lower()


def spans_of(text: str | None) -> list[tuple]:
    """Base spans (``kind`` 0 to 3) and candidates (-1) with their instance and patterns."""
    if not text:
        return []
    base = base_spans(text)
    found = [(a, b, kind, 1 << kind) for a, kind, b in base]
    found = sorted(found + [(a, b, -1, bits) for a, b, bits in _candidates(text, base)])
    patterns = _with_patterns(text, [(a, b) for a, b, *_ in found])
    return [(a, b, kind, bits, _instance(text[a:b], bits >= 4), held) for (a, b, kind, bits), held in zip(found, patterns)]


def _spans(texts: pd.Series) -> pd.Series:
    names = ("start", "stop", "kind", "may_be", "instance", "patterns")
    return texts.map(lambda t: [dict(zip(names, s)) for s in spans_of(t)], na_action=None)


def found_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row``, ``key`` and ``spans``, base and candidates, one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    spans = F.pandas_udf(_spans, f"array<struct<{SPAN}>>")(docs[text])
    known = docs.select(docs[key].alias("key"), spans.alias("spans"))
    return stored(known.withColumn("row", F.monotonically_increasing_id()), "personal_spans")


def confident_patterns(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pattern``, ``kind``, ``confidence`` after the last round.

    ``edges``: distinct ``pattern``, ``instance``, ``may_be``; ``seeds``: distinct ``instance``, ``kind``.
    """
    totals = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("held"))
    known = seeds.withColumns({"score": F.lit(MILLION).cast("long"), "seed": F.lit(1)})
    scores = known
    for number in range(rounds):
        brought = edges.join(scores, "instance").groupBy("pattern", "kind").agg(
            F.sum("score").alias("brought"), F.sum("seed").alias("seeds")
        )
        confidence = F.floor(F.col("brought") / (F.col("held") + 1))
        rated = brought.where(F.col("seeds") >= MIN_SEEDS).join(totals, "pattern")
        rated = rated.select("pattern", "kind", confidence.cast("long").alias("confidence"))
        confident = stored(rated.where(F.col("confidence") >= MIN_CONFIDENCE), "personal_patterns")
        if number + 1 < rounds:
            fits = F.col("may_be").bitwiseAND(F.expr("shiftleft(1, kind)")) > 0
            unseen = edges.join(seeds.select("instance").distinct(), "instance", "left_anti")
            lifted = unseen.join(confident, "pattern").where(fits)
            best = lifted.groupBy("instance").agg(F.max(F.struct("confidence", -F.col("kind"))).alias("best"))
            lifted = best.select("instance", (-F.col("best.col2")).alias("kind"), F.col("best.confidence").alias("score"))
            scores = stored(known.unionByName(lifted.withColumn("seed", F.lit(0))), "personal_scores")
    return confident


def personal_spans(found: DataFrame) -> DataFrame:
    """``row``, ``start``, ``stop``, ``kind``, ``is_base`` for every span, base and discovered."""
    each = found.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    base = each.where("kind >= 0")
    standing = each.select("instance", "may_be", "kind", F.explode("patterns").alias("pattern"))
    edges = standing.groupBy("pattern", "instance").agg(F.bit_or("may_be").alias("may_be"))
    seeds = base.select("instance", "kind").distinct()
    confident = confident_patterns(stored(edges, "personal_edges"), stored(seeds, "personal_seeds"))
    open_ = each.where("kind < 0").select("row", "start", "stop", "may_be", F.explode("patterns").alias("pattern"))
    fits = F.col("may_be").bitwiseAND(F.expr("shiftleft(1, kind)")) > 0
    met = open_.join(confident, "pattern").where(fits)
    best = met.groupBy("row", "start", "stop").agg(F.max(F.struct("confidence", -F.col("kind"))).alias("best"))
    discovered = best.select("row", "start", "stop", (-F.col("best.col2")).alias("kind"), F.lit(False).alias("is_base"))
    return base.select("row", "start", "stop", "kind", F.lit(True).alias("is_base")).unionByName(discovered)


def _listed(spans: Column) -> Column:
    """kind:start:end of ordered spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    shown = F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["stop"]))
    return F.array_join(shown, ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, the digest of the base spans and all spans, one row per row of ``docs``."""
    found = found_spans(docs)
    place = F.struct("start", "kind", "stop")
    more = personal_spans(found).where("NOT is_base").groupBy("row").agg(F.collect_list(place).alias("more"))
    base = F.transform(
        F.filter("spans", lambda s: s["kind"] >= 0), lambda s: F.struct(s["start"], s["kind"], s["stop"])
    ).cast("array<struct<start: int, kind: int, stop: int>>")
    rows = found.select("row", "key", base.alias("base")).join(more, "row", "left")
    every = F.array_sort(F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more")))
    counts = [_count(kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return rows.select(
        F.col("key").alias("doc_id"), *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(every).alias("spans"),
    )
