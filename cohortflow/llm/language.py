"""Operator 9, language identification: hyperdimensional profiles.

Each letter has a random vector of signs. A run of three letters is the product of its letters' vectors, each
permuted (rolled) by its place in the run, and a text is the sum of its runs' vectors. A language's prototype
is the sum over its texts of their vectors, each of length one. A text gets the language whose prototype has
the largest cosine with it; the score is that cosine, at least 0.

Prototypes are learned on up to ``PER_LANGUAGE`` texts of each language (the documented bound), those with the
smallest hash of their id; each text is read whole, in learning as in prediction.

Defined results: null text, and text without a letter, is ``und`` with score 0; rows of null language or null
id are never learned from; ties go to the first language by name; with no learned language all are ``und``; an
empty table gives an empty result; rows may be repeated; other columns are ignored.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import held_out, only_marked, ship, slices, stored, text_of

SIZE = 1024
PER_LANGUAGE = 600
SEED = 9
OUT = "doc_id long, held_out boolean, lang_pred string, score double"
#: Texts whose vectors are made at once: so many code points (or one text), and so many texts.
TOGETHER, TEXTS = 1 << 18, 256
#: Longer texts are read in stretches of so many code points; runs across two stretches are left out.
STRETCH = 1 << 20


@cache
def _is_letter():
    """For each code point its lower-case letter, 0 for those of white space, -1 for those that count for nothing."""
    import sys

    import numpy as np

    out = np.full(sys.maxunicode + 1, -1, np.int32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            out[c] = ord(ch.lower()[0])
        elif ch.isspace():
            out[c] = 0
    return out


@cache
def _letter(code: int):
    """The vector of signs of a letter (0: white space)."""
    import numpy as np

    return np.random.default_rng([SEED, code]).integers(0, 2, SIZE, np.int8).astype(np.float32) * 2 - 1


def vectors(texts: list[str]):
    """A row for each text: the sum of its runs' vectors (zeros without a letter)."""
    import numpy as np

    out = np.zeros((len(texts), SIZE), np.float32)
    if not any(texts):
        return out
    if len(texts) == 1 and len(texts[0]) > STRETCH:
        for at in range(0, len(texts[0]), STRETCH):
            out += vectors([texts[0][at:at + STRETCH]])
        return out
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    letter = _is_letter()[codes]
    keep = letter >= 0
    letter, doc = letter[keep], doc[keep]
    if len(letter) < 3:
        return out
    a, b, c = letter[:-2], letter[1:-1], letter[2:]
    whole = (doc[:-2] == doc[2:]) & (b > 0) & ((a > 0) | (c > 0))  # inside one text, and about a letter
    used = np.unique(letter)
    place = np.zeros(int(used[-1]) + 1, np.int64)
    place[used] = np.arange(len(used))
    run = (place[a] * len(used) + place[b]) * len(used) + place[c]
    run, doc = run[whole], doc[:-2][whole]
    if not len(run):
        return out
    runs, at = np.unique(run, return_inverse=True)
    base = np.stack([_letter(int(x)) for x in used])
    first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    for low in range(0, len(runs), 8192):  # the runs' vectors, so many at a time
        some = runs[low:low + 8192]
        bound = first[some // len(used) ** 2] * second[some // len(used) % len(used)] * base[some % len(used)]
        mine = (at >= low) & (at < low + 8192)
        counts = np.bincount(doc[mine] * len(some) + at[mine] - low, minlength=len(texts) * len(some))
        out += counts.reshape(len(texts), len(some)).astype(np.float32) @ bound
    return out


def unit(rows):
    import numpy as np

    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _together(texts: list[str]):
    """Slices of the list with a bounded number of code points."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > TOGETHER or i - start == TEXTS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    yield slice(start, len(texts))


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE):
    """Languages by name, and their prototypes: one vector for each."""
    import numpy as np

    ship(docs.sparkSession)
    # the sample's ids come from narrow columns; texts are read for it alone
    ids = (docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
           .select("doc_id", F.xxhash64(F.lit(SEED), "doc_id").alias("h"), "lang")
           .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
           .where(F.col("n") <= per_language).select("doc_id").distinct())
    ids = stored(ids)
    rows = docs.where(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "lang", text_of().alias("text"))
    sample = only_marked(rows, "doc_id", ids.toDF("key")).join(ids, "doc_id", "left_semi").select("lang", "text")

    def sums(batches):
        import pandas as pd

        total: dict[str, object] = {}
        for pdf in batches:
            texts = pdf["text"].tolist()
            for part in _together(texts):
                rows = unit(vectors(texts[part]))
                for lang, row in zip(pdf["lang"].iloc[part], rows, strict=True):
                    total[lang] = row + total[lang] if lang in total else row
        if total:
            yield pd.DataFrame({"lang": list(total), "sum": [x.tolist() for x in total.values()]})

    found: dict[str, object] = {}
    for r in sample.mapInPandas(sums, "lang string, sum array<double>").sort("lang").toLocalIterator():  # a vector for each task and language
        found[r["lang"]] = np.asarray(r["sum"]) + found.get(r["lang"], 0)
    langs = sorted(found)
    return langs, unit(np.stack([found[x] for x in langs])).astype(np.float32) if langs else np.zeros((0, SIZE), np.float32)


def predict(docs: DataFrame, langs: list[str], prototypes) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast((langs, prototypes))

    def predicted(batches):
        import numpy as np
        import pyarrow as pa

        names, rows = model.value
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            langs, scores = [], []
            for part in _together(texts):
                of = vectors(texts[part])
                near = unit(of) @ rows.T if len(names) else np.zeros((len(of), 1), np.float32)
                best = near.argmax(axis=1)
                some = of.any(axis=1)
                for t, b, s, v in zip(texts[part], best, near.max(axis=1), some, strict=True):
                    known = bool(names) and (v or any(map(str.isalpha, t)))
                    langs.append(names[b] if known else "und")
                    scores.append(min(1.0, max(0.0, float(s))) if known else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), text_of().alias("text")).mapInArrow(predicted, OUT)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    return predict(docs, *learn(docs, per_language))
