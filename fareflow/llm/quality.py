"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio. Built-in expressions only.

Words and word pairs fall into a fixed number of hash buckets. The raw multinomial is their share
in all documents. The target multinomial is that of a corpus of trusted documents only: each
bucket's raw share times its rate of trust, the share of trusted text in its labelled text over
the overall share. ``PRIOR`` n-grams at the overall share, held by every bucket beforehand, draw
the rate to one. The overall share is that by which the target shares add up to one; it weighs
buckets as the raw corpus does. A bucket's weight is the log of its target share over its raw
share: an n-gram that no label covers, as of a new language, weighs zero, however large the
corpus. A document's score is the mean weight of its n-grams, so length does not matter, and a
document stays if its score reaches a fixed threshold.

Counting combines before its shuffle to at most one row per bucket and task. The weights
are an array of fixed length that reaches the scan as a scalar subquery; scoring reads
every row by itself, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, stored

BUCKETS = 10_000
SMOOTHING = 0.5
# Mean log ratio per n-gram that a document must reach; the README says how it was chosen.
THRESHOLD = -0.05
# How many n-grams at the overall share of trusted text every bucket holds beforehand.
PRIOR = 10.0
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SPACE = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3
JUDGED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept")


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def _after(words: Column, skip: int) -> Column:
    return F.slice(words, skip + 1, F.greatest(F.size(words), F.lit(1)))


def pair_hashes(words: Column) -> Column:
    """The hash of each word with the next; the last word's is of no pair."""
    return F.zip_with(words, _after(words, 1), lambda a, b: F.xxhash64(a, b))


def _first(values: Column, words: Column, fewer: int) -> Column:
    return F.slice(values, 1, F.greatest(F.size(words) - fewer, F.lit(0)))


def _bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int")


def buckets_of(words: Column, pairs: Column) -> Column:
    """The hash buckets of a document's words and word pairs, repeats included."""
    paired = F.transform(_first(pairs, words, 1), lambda p: _bucket(p))
    return F.concat(F.transform(words, lambda w: _bucket(F.xxhash64(w))), paired)


def bucket_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``bucket``, ``n`` over all rows."""
    words = docs.select(words_of(F.col(text)).alias("words"))
    return words.select(F.explode(buckets_of(F.col("words"), pair_hashes(F.col("words")))).alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n")
    )


def bucket_weights(labelled: DataFrame, raw: DataFrame, text: str = "text") -> DataFrame:
    """One row, ``weights``: the log ratio of target to raw share by bucket.

    ``labelled`` has the column ``good``. Without trusted n-grams all are zero.
    """
    spark = raw.sparkSession
    words = labelled.select(words_of(F.col(text)).alias("words"), "good")
    buckets = buckets_of(F.col("words"), pair_hashes(F.col("words")))
    judged = words.select(F.explode(buckets).alias("bucket"), "good").groupBy("bucket").agg(
        F.count_if("good").alias("t"), F.count(F.lit(1)).alias("l")
    )
    every = bucket_counts(raw, text).select("bucket", F.col("n").alias("r"))
    counts = stored(
        spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
        .join(judged, "bucket", "left").join(every, "bucket", "left").na.fill(0, ["t", "l", "r"]),
        "quality_counts",
    )
    t, held = F.col("t"), F.col("l") + PRIOR
    raw_share = F.col("r") + SMOOTHING  # up to a factor, which the ratio below loses
    sums = counts.agg(F.sum(raw_share * t / held).alias("t"), F.sum(raw_share * F.col("l") / held).alias("l")).first()
    weight = F.lit(0.0)
    if sums.t:
        overall = sums.t / sums.l
        weight = F.log((t + PRIOR * overall) / (held * overall))
    entries = F.array_sort(F.collect_list(F.struct("bucket", weight.alias("w"))))
    return counts.agg(F.transform(entries, lambda e: e["w"]).alias("weights"))


def _repeated_words(hashes: Column) -> Column:
    """How many words lie in windows that occur twice or more, by the windows' hashes in order."""
    by_hash = F.array_sort(F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(seen: Column, at: Column) -> Column:
        new = at + WINDOW - F.greatest(at, seen["end"])
        return F.struct((at + WINDOW).alias("end"), (seen["n"] + new).alias("n"))

    def counted(windows: Column) -> Column:
        pairs = F.arrays_zip(windows.alias("a"), _after(windows, 1).alias("b"))
        equal = F.filter(pairs, lambda p: p["a"]["h"] == p["b"]["h"])
        places = F.flatten(F.transform(equal, lambda p: F.array(p["a"]["at"], p["b"]["at"])))
        return F.aggregate(F.array_sort(F.array_distinct(places)), start, add)["n"].cast("long")

    # As an array of one, the sorted windows are a variable, so they are sorted once.
    repeated = F.transform(F.array(by_hash), counted)[0]
    # Most texts repeat no window; finding that out takes no sorting.
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(repeated)


def _window_hashes(words: Column, pairs: Column) -> Column:
    """A 64-bit hash of every three words in a row."""
    return _first(F.zip_with(pairs, _after(words, 2), lambda p, c: F.xxhash64(p, c)), words, WINDOW - 1)


def with_quality(
    docs: DataFrame, weights: DataFrame, into: str, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with a struct column ``into``: the base counts, the ``score`` and the verdict.

    Null and empty texts have no words, score zero and fail. Windows are compared by their
    64-bit hash. Rows are judged one by one, so repeated rows and any other columns stay.
    """
    names = {n: f"{into}_{n}" for n in ("text", "words", "lines", "pairs", "buckets", "windows", "table")}
    at = {n: F.col(c) for n, c in names.items()}
    lines = F.filter(F.split(at["text"], "\n"), lambda line: F.rlike(line, F.lit(f"[^{SPACE}]")))
    read = docs.withColumn(names["text"], F.coalesce(F.col(text), F.lit("")))
    read = read.withColumns({names["words"]: words_of(at["text"]), names["lines"]: lines})
    read = read.withColumn(names["pairs"], pair_hashes(at["words"]))
    read = read.withColumns(
        {
            names["buckets"]: buckets_of(at["words"], at["pairs"]),
            names["windows"]: _window_hashes(at["words"], at["pairs"]),
            names["table"]: weights.scalar(),
        }
    )

    total = F.aggregate(at["buckets"], F.lit(0.0), lambda sum_, b: sum_ + F.get(at["table"], b))
    mean = F.coalesce(F.try_divide(total, F.size(at["buckets"])), F.lit(0.0))
    n_words = F.size(at["words"]).cast("long")
    # A row number in the struct keeps Spark from copying all of this into a filter on the verdict.
    base = F.struct(
        F.monotonically_increasing_id().alias("row"),
        n_words.alias("n_words"),
        F.length(F.array_join(at["words"], "")).cast("long").alias("word_chars"),
        F.regexp_count(at["text"], F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(at["lines"]) - F.size(F.array_distinct(at["lines"]))).cast("long").alias("n_dup_lines"),
        _repeated_words(at["windows"]).alias("n_repeat_words"),
        mean.alias("score"),
    )
    counted = read.withColumn(into, base).drop(*names.values())
    got = F.col(into)
    failed = (got["n_words"] < MIN_WORDS) | (
        100 * got["n_repeat_words"] > MAX_REPEATED_PERCENT * got["n_words"]
    )
    kept = ~failed & (got["score"] >= threshold)
    return counted.withColumn(
        into, got.withField("base_failed", failed).withField("kept", kept)
    )


def labelled_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The texts of documents that labels call good or bad, and whether they are trusted (``good``).

    Trusted is what some label calls good and none calls bad or toxic. Without either word, as
    where the quality is null, a label counts against trust but is no evidence. Labels
    grow with the documents, so the join is by shuffle at every size.
    """
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    bad = F.coalesce((F.col("quality") != 1) | (F.coalesce("toxic", F.lit(0)) != 0), F.lit(False))
    agreed = labels.groupBy(key).agg(F.min(good).alias("good"), F.max(bad).alias("bad"))
    agreed = agreed.where("good or bad").select(key, "good")
    return docs.select(key, "text").join(agreed.hint("merge"), key)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: counts, score, ``base_failed`` and ``kept``."""
    weights = stored(bucket_weights(labelled_documents(docs, labels, key), docs), "quality_weights")
    judged = with_quality(docs.select(key, "text"), weights, "q")
    return judged.select(key, *[f"q.{name}" for name in JUDGED])


def good_only(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without those that fail the rules."""
    into = free_name(docs, "_quality")
    weights = stored(bucket_weights(labelled_documents(docs, labels, key), docs), "quality_weights")
    return with_quality(docs, weights, into).where(F.col(into)["kept"]).drop(into)
