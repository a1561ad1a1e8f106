"""Operator 10, toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is a run of letters, in lower case; its subwords are its runs of 3 to 5 characters, the word's ends
counting as characters. Each subword has an embedding in a table of ``BUCKETS`` rows, chosen by hash, so a
misspelling shares most of its subwords' vectors with the word. A word's vector is the mean of its subwords',
a text's the mean of its words'. Embeddings and softmax are learned together by gradient steps (Adam).

Learning takes up to ``PER_LABEL`` texts of each label (the documented bound), those with the smallest hash of
their id, whole. Tasks turn them into buckets and weights, so no whole text reaches the fit. Only buckets that are in
clearly more texts of one label than of the other (``LEAST_Z`` standard errors) are learned: the others would only
mark the texts they are in. The gradient steps then run on these few numbers in one task. Since mean and softmax are
linear, a text's score is computed from one number for each bucket.

Defined results: null text counts as empty; a text without a letter has the score of the intercept alone;
labels of null id or null value are not learned from, a document with several labels takes part with each;
with fewer than two labels every score is that label, or 0 without labels; an empty table gives an empty
result; rows may be repeated; other columns are ignored.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import held_out, only_marked, partitions, ship, slices, stored, text_of

BUCKETS, SIZE = 1 << 18, 4
RUNS = (3, 4, 5)
PER_LABEL = 4000
#: A label's texts are ranked in so many parts first.
PARTS = 64
STEPS, RATE, MOMENTUM = 300, 50.0, 0.9
#: Subwords of fewer texts, or with a smaller contrast between the labels, are not learned.
LEAST_TEXTS, LEAST_Z = 5, 4.0
#: Means over hundreds of words are small: they are multiplied by this before the softmax.
SCALE = 20.0
SEED = 10
OUT = "doc_id long, held_out boolean, score double, predicted int"
#: Texts read at once: so many code points, or one text. A longer text is read in stretches of so many.
TOGETHER = 1 << 17


@cache
def _letters():
    """For each code point itself if a letter, else 0."""
    import sys

    import numpy as np

    return np.fromiter((c if chr(c).isalpha() else 0 for c in range(sys.maxunicode + 1)), np.uint32, sys.maxunicode + 1)


def subwords(texts: list[str]):
    """Text, bucket and weight of each subword; the weights of a text add up to the number of its words. Words by text."""
    import numpy as np

    code = _letters()[np.frombuffer((" ".join(["", *texts, ""])).lower().encode("utf-32-le", "surrogatepass"), np.uint32)] if len(texts) else np.empty(0, np.uint32)
    lower = [len(t.lower()) + 1 for t in texts]
    doc = np.repeat(np.arange(len(texts)), lower)  # of positions from 1 on; each text is followed by a space
    letter = code > 0
    starts = letter[1:] & ~letter[:-1]
    word = np.cumsum(starts) - 1  # of the character one after the position
    words = np.bincount(doc[starts[:len(doc)]], minlength=len(texts))
    found, of = [], []
    for n in RUNS:
        m = len(code) - n + 1
        inside = letter[1:m + 1].copy()
        for k in range(2, n - 1):
            inside &= letter[k:m + k]
        at = np.flatnonzero(inside)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + code[at + k]
        h ^= h >> np.uint64(29)
        found.append(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 18)).astype(np.int64))
        of.append(word[at])
    bucket, of = np.concatenate(found), np.concatenate(of)
    each = 1.0 / np.maximum(1, np.bincount(of, minlength=len(word) and int(word[-1]) + 1))
    return doc[np.flatnonzero(starts)][of] if len(of) else of, bucket, each[of], words


def _together(texts: list[str]):
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > TOGETHER:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if texts:
        yield slice(start, len(texts))


def features(texts: list[str]):
    """The buckets of each text and their weights, which add up to 1 (nothing for a text without a letter)."""
    import numpy as np

    for part in _together(texts):
        if len(texts[part]) == 1 and len(t := texts[part][0]) > TOGETHER:  # a long text, stretch by stretch
            total, n = np.zeros(BUCKETS), 0
            for at in range(0, len(t), TOGETHER):
                _, bucket, weight, words = subwords([t[at:at + TOGETHER]])
                total += np.bincount(bucket, weight, BUCKETS)
                n += int(words[0])
            there = np.flatnonzero(total)
            yield there.astype(np.int32), (total[there] / max(1, n)).astype(np.float32)
            continue
        doc, bucket, weight, words = subwords(texts[part])
        key, at = np.unique(doc * BUCKETS + bucket, return_inverse=True)
        total = np.bincount(at, weight)
        ends = np.searchsorted(key, np.arange(len(words) + 1) * BUCKETS)
        for i, (low, high) in enumerate(zip(ends, ends[1:], strict=False)):
            yield (key[low:high] % BUCKETS).astype(np.int32), (total[low:high] / max(1, words[i])).astype(np.float32)


def contrast(one: Column, zero: Column, ones: Column, zeros: Column) -> Column:
    """How many standard errors the shares of the two labels' texts that have a bucket lie apart."""
    share = (one + zero) / (ones + zeros)
    return F.abs(one / ones - zero / zeros) / F.sqrt(F.greatest(share * (1 - share) * (1 / ones + 1 / zeros), F.lit(1e-12)))


def fit(doc, bucket, weight, y):
    """One number for each bucket, and the intercept: the log odds of label 1 are their mean over words, and it.

    ``doc``, ``bucket`` and ``weight`` are the learned subwords of the texts, ``y`` the texts' labels (both occur).
    Embeddings and softmax take joint gradient steps with momentum over all texts; both labels weigh the same.
    """
    import numpy as np

    used, b = np.unique(bucket, return_inverse=True)
    rng = np.random.default_rng(SEED)
    table, out, bias = rng.normal(0, 0.01, (len(used), SIZE)), rng.normal(0, 1, SIZE), 0.0
    out /= np.linalg.norm(out)  # of the two classes of a softmax only the difference matters
    m_table, m_out, m_bias = np.zeros_like(table), np.zeros_like(out), 0.0
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y != 1).sum()))
    for _ in range(STEPS):
        bag = np.stack([np.bincount(doc, weight * table[b, k], len(y)) for k in range(SIZE)], 1) * SCALE
        error = (1 / (1 + np.exp(-np.clip(bag @ out + bias, -30, 30))) - y) * each
        back = np.bincount(b, weight * error[doc], len(used)) * SCALE
        m_table = MOMENTUM * m_table - RATE * np.outer(back, out)
        m_out = MOMENTUM * m_out - RATE / 1000 * (bag.T @ error)
        m_bias = MOMENTUM * m_bias - RATE / 100 * error.sum()
        table, out, bias = table + m_table, out + m_out, bias + m_bias
    model = np.zeros(BUCKETS)
    model[used] = table @ out * SCALE
    return model, float(bias)


def scores(texts: list[str], table, intercept: float) -> list[float]:
    """The probability of label 1 of each text."""
    import numpy as np

    out: list[float] = []
    for part in _together(texts):
        chunk, owner = [], []
        for i, t in enumerate(texts[part]):
            for at in range(0, max(1, len(t)), TOGETHER):
                chunk.append(t[at:at + TOGETHER])
                owner.append(i)
        total, count = np.zeros(len(texts[part])), np.zeros(len(texts[part]))
        doc, bucket, weight, words = subwords(chunk)
        np.add.at(total, owner, np.bincount(doc, weight * table[bucket], len(chunk)))
        np.add.at(count, owner, words)
        odds = total / np.maximum(1, count) + intercept
        out += (1 / (1 + np.exp(-np.clip(odds, -500, 500)))).tolist()
    return out


def sampled(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """doc_id and toxic of the texts to learn from. A label is ranked in parts first, so no task meets all its rows."""
    ids = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
           .select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64(F.lit(SEED), "doc_id").alias("h")).distinct()
           .join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("part", F.pmod("h", F.lit(PARTS))))
    for key in (["toxic", "part"], ["toxic"]):
        ids = ids.withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy("h", "doc_id"))).where(F.col("n") <= per_label)
    return ids.select("doc_id", "toxic")


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL):
    """The model: one number for each bucket, and the intercept."""
    import numpy as np

    spark = docs.sparkSession
    ship(spark)
    ids = stored(sampled(docs, labels, per_label))
    rows = docs.select("doc_id", text_of().alias("text"))
    sample = only_marked(rows, "doc_id", ids.select(F.col("doc_id").alias("key"))).join(ids, "doc_id").select("doc_id", "text", "toxic")

    def described(batches):
        import pyarrow as pa

        for batch in slices(batches, 100):
            found = list(features([t or "" for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array([b for b, _ in found], pa.list_(pa.int32())),
                                              pa.array([w for _, w in found], pa.list_(pa.float32()))], ["doc_id", "toxic", "buckets", "weights"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # few texts, but long work: dealt out to a fixed number of tasks, which are not put together again
    texts = stored(sample.repartition(partitions(docs), "doc_id").mapInArrow(described, f"doc_id {kind}, toxic int, buckets array<int>, weights array<float>"))
    totals = texts.agg(*(F.coalesce(F.sum((F.col("toxic") == k).cast("long")), F.lit(0)) for k in (1, 0))).first()
    if not min(totals):
        return np.zeros(BUCKETS, np.float32), (40.0 if totals[0] else -40.0)
    ones, zeros = (F.lit(float(n)) for n in totals)
    count = lambda k: F.sum((F.col("toxic") == k).cast("double"))
    counts = texts.select("toxic", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(count(1).alias("one"), count(0).alias("zero"))
    chosen = counts.where((F.col("one") + F.col("zero") >= LEAST_TEXTS) & (contrast(F.col("one"), F.col("zero"), ones, zeros) >= LEAST_Z))
    chosen = np.sort(np.asarray(chosen.select("bucket").toArrow().column(0)))  # at most BUCKETS
    flags = np.zeros(BUCKETS, bool)
    flags[chosen] = True
    mark = spark.sparkContext.broadcast(flags)

    def cut(batches):
        import pyarrow as pa

        for batch in slices(batches, 100):
            rows = [(b.values.to_numpy(), w.values.to_numpy()) for b, w in zip(batch.column("buckets"), batch.column("weights"), strict=True)]
            rows = [(b[mark.value[b]], w[mark.value[b]]) for b, w in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array([b for b, _ in rows], pa.list_(pa.int32())),
                                              pa.array([w for _, w in rows], pa.list_(pa.float32()))], ["doc_id", "toxic", "buckets", "weights"])

    def fitted(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values(["doc_id", "toxic"])
        doc = np.repeat(np.arange(len(pdf)), pdf["buckets"].map(len))
        table, intercept = fit(doc, np.concatenate(pdf["buckets"].tolist()).astype(int), np.concatenate(pdf["weights"].tolist()),
                               (pdf["toxic"].to_numpy() == 1).astype(int))
        return pd.DataFrame({"table": [table], "intercept": [intercept]})

    few = texts.mapInArrow(cut, texts.schema)
    model = few.withColumn("model", F.lit(0)).groupBy("model").applyInPandas(fitted, "table array<double>, intercept double").first()
    return np.asarray(model["table"], np.float32), model["intercept"]


def predict(docs: DataFrame, table, intercept: float) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast((table, intercept))  # BUCKETS numbers

    def scored(batches):
        import pyarrow as pa

        table, intercept = model.value
        for batch in slices(batches):
            found = scores([t or "" for t in batch.column("text").to_pylist()], table, intercept)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64()),
                                              pa.array([int(x >= 0.5) for x in found], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), text_of().alias("text")).mapInArrow(scored, OUT)


def score(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    return predict(docs, *learn(docs, labels, per_label))


def clean(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """The documents, with all their columns, that are not predicted toxic."""
    table, intercept = learn(docs, labels, per_label)
    model = docs.sparkSession.sparkContext.broadcast((table, intercept))

    def kept(batches):
        import pyarrow as pa

        for batch in slices(batches):
            found = scores([t or "" for t in batch.column("text").to_pylist()], *model.value)
            yield batch.filter(pa.array([x < 0.5 for x in found], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
