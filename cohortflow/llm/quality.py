"""Operator 13, quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus [native].

A text's tokens are its runs of ASCII punctuation and its runs of other characters that are not white space. Tokens
and pairs of adjacent tokens (the n-grams) fall into ``buckets`` by crc32. Two multinomials over the buckets, one of
the trusted documents (those with label quality 1) and one of all documents, are counted over the whole tables and
smoothed with one n-gram for each bucket. A bucket's weight is the logarithm of their ratio in whole millionths, so
sums are exact in any order. A document's verdict is its sum of weights divided by its number of n-grams, against a
fixed threshold: no draw takes part, and every document is judged.

Rules that need no model come first (``base_failed``): fewer than ``LEAST_WORDS`` words, or more than half of the
words in 3-word windows that the text repeats.

All of a document is computed in its row: no shuffle moves a text. The only exchange is of the bucket counts, at most
``buckets`` for each task, and the weights (``buckets`` numbers) go to the tasks as one array.

Defined results: null and empty texts have no words, fail the base rules and are not kept; labels with a null id or
null quality count for nothing, repeated labels of one document once; rows equal in id count each; with no trusted
document at all every weight is 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import only_marked, text_of

BUCKETS = 1 << 14
LEAST_WORDS = 50
#: Percent of the words that repeated windows may cover.
MOST_REPEATED = 50
WINDOW = 3
#: Least mean weight of a kept document's n-grams, in millionths of a nat.
THRESHOLD = -400_000
SYMBOLS = r"[#*$%&|<>]"
# single characters, not ranges: a regular expression then tests a character by one look into a table
WHITE = r" \t\n\x0B\f\r"
PUNCTUATION = r"!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~"
TOKEN = f"[{PUNCTUATION}]+|[^{PUNCTUATION}{WHITE}]+"
#: A pair of tokens falls into the bucket of this many times the first token's crc32 plus the second's.
PAIR = 31


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{WHITE}]+", -1), "")


def _indices(n: Column) -> Column:
    """0 to n - 1; none for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def repeated_words(w: Column) -> Column:
    """The number of words that lie in a window of ``WINDOW`` words found twice or more.

    Windows of one text are told apart by a 64-bit hash. Only texts that repeat a window are looked at further:
    sorted, equal windows are neighbours, so the work is n log n for any text.
    """
    window = lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW)))

    def covered(s: Column) -> Column:
        alike = lambda k, j: F.coalesce(F.get(s, k)["h"] == F.get(s, j)["h"], F.lit(False))
        twice = F.filter(_indices(F.size(s)), lambda k: alike(k, k - 1) | alike(k, k + 1))
        at = F.flatten(F.transform(twice, lambda k: F.array(*(F.get(s, k)["i"] + j for j in range(WINDOW)))))
        return F.size(F.array_distinct(at)).cast("long")

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(placed, covered))

    return let(F.transform(_indices(F.size(w) - (WINDOW - 1)), window), count)


def repeated_lines(text: Column) -> Column:
    """The number of lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{WHITE}]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def grams(text: Column, buckets: int) -> Column:
    """The bucket of each token, then of each pair of adjacent tokens and a null."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return let(F.transform(tokens, lambda t: F.crc32(t.cast("binary"))), lambda c: F.concat(
        F.transform(c, lambda x: (x % buckets).cast("int")),
        F.transform(c, lambda x, i: ((PAIR * x + F.get(c, i + 1)) % buckets).cast("int"))))


def _counts(texts: DataFrame, buckets: int) -> DataFrame:
    return texts.select(F.explode(grams(text_of(), buckets)).alias("bucket")).where("bucket IS NOT NULL").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with ``weights``: for each bucket the log-likelihood ratio in millionths. ``trusted`` has doc_id."""
    ids = trusted.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("key")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), text_of().alias("text"))
    target = only_marked(rows, "key", ids).join(ids, "key", "left_semi")
    both = (_counts(rows, buckets).select("bucket", F.col("n").alias("r"), F.lit(0).cast("long").alias("t"))
            .unionByName(_counts(target, buckets).select("bucket", F.lit(0).cast("long").alias("r"), F.col("n").alias("t")))
            .unionByName(docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("r"),
                                                                 F.lit(0).cast("long").alias("t")))
            .groupBy("bucket").agg(F.sum("r").alias("r"), F.sum("t").alias("t")))
    counts = both.agg(F.sort_array(F.collect_list(F.struct("bucket", "r", "t"))).alias("c"), F.sum("r").alias("nr"), F.sum("t").alias("nt"))

    def ratio(x: Column) -> Column:
        log = lambda n, total: F.log((n + 1).cast("double") / (total + buckets).cast("double"))
        return F.when(F.col("nt") == 0, 0).otherwise(F.round((log(x["t"], F.col("nt")) - log(x["r"], F.col("nr"))) * 1e6)).cast("long")

    return counts.select(F.transform("c", ratio).alias("weights"))


def quality(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_grams, llr_sum and kept of each document."""
    text = F.col("text")
    # the analyser takes no subquery inside a function of arrays, but the optimiser joins these two projections: the
    # tasks then read the one array, and no row carries it
    rows = docs.select("doc_id", text_of().alias("text"), weights(docs, trusted, buckets).scalar().alias("model"))
    found = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("again")))
    verdict = let(F.col("model"), lambda m: let(grams(text, buckets), lambda g: F.struct(
        F.greatest(F.size(g) - 1, F.lit(0)).cast("long").alias("n_grams"),
        F.aggregate(g, F.lit(0).cast("long"), lambda total, b: total + F.coalesce(F.get(m, b), F.lit(0))).alias("llr_sum"))))
    out = rows.select("doc_id", found.alias("w"), (F.size(F.split(text, SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
                      repeated_lines(text).alias("n_dup_lines"), verdict.alias("v"))
    n, again = F.col("w.n_words"), F.col("w.again")
    failed = (n < LEAST_WORDS) | (100 * again > MOST_REPEATED * n)
    return out.select("doc_id", n.alias("n_words"), "w.word_chars", "n_symbols", "n_dup_lines", again.alias("n_repeat_words"),
                      failed.alias("base_failed"), "v.n_grams", "v.llr_sum", (~failed & (F.col("v.llr_sum") >= threshold * F.col("v.n_grams"))).alias("kept"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The documents that the labels call good."""
    return labels.where(F.col("quality") == 1).select("doc_id")
