"""A corpus in five stages: toxicity, line dedup, near-dedup, mixing by source, tokens.

Each stage takes documents (doc_id, text, lang, source, n_chars) and returns documents, the last one a row of
token figures for each. ``run`` writes each stage's rows as Parquet to the shared folder and reads them again.

Defined results: columns other than the five are dropped, whatever their names. Null text counts as empty in every
stage; an empty or null text is never toxic by its words, has no lines to lose, is near to nothing, and ends in the mixing, which
takes words. Null languages and sources are kept; a null source is a source of its own. Rows with a null id are
never learned from and never near duplicates, and are mixed like others. Equal rows stay through toxicity and line dedup (cut alike),
and one of them through near-dedup; ties are broken by id and text. Texts of any length are worked through whole. An
empty table gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import lines, mixing, near, pieces, toxicity
from cohortflow.llm.common import read, stored
from cohortflow.session import drop_intermediates, intermediates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a shingle and similarity of near duplicates.
WORDS, NUM, DEN = 5, 80, 100
#: Bytes of the tokenizer's store in each worker: the stages before have filled the executor's heap, which stays as it is.
KEPT = 24 << 20


_BEGAN: dict[str, int] = {}


def _tidied(spark: SparkSession, docs: DataFrame | None) -> None:
    """Deletes the tables that the stage before has written on its way: its rows are written, and are ``docs`` now."""
    app = spark.sparkContext.applicationId
    if docs is not None and app in _BEGAN:
        drop_intermediates(spark, _BEGAN[app], docs.inputFiles())
    _BEGAN[app] = intermediates(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic; the model learns from the labels of the documents given."""
    _tidied(spark, None)
    return toxicity.clean(docs.select(COLUMNS), read(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of lines that are equal or nearly so, the first occurrence stays."""
    _tidied(spark, docs)
    cut = lines.line_dedup(docs.select(COLUMNS))
    return cut.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id."""
    _tidied(spark, docs)
    return near.one_of_each(docs.select(COLUMNS), WORDS, NUM, DEN)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of the documents, a row for each pass over a document's source."""
    _tidied(spark, docs)
    return mixing.mixed_documents(docs.select(COLUMNS)).select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's tokens, and of the text they decode to."""
    _tidied(spark, docs)
    return pieces.encode_decode(docs, pieces.tokenizer_model(), KEPT)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: Training, MinHash and the tokenizer have no SQL form; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
