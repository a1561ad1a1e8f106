"""Operator 2, exact dedup: deterministic block naming [native].

A text without white space is cut into blocks of ``block_bytes`` UTF-8 bytes. The distinct blocks are sorted
and numbered: equal blocks get one integer name, different blocks different ones. Adjacent names are then
paired and the distinct pairs sorted and numbered again, until each document has a single name. Two documents
end at the same level with the same name exactly if their texts are equal; no hash decides that.

Names are looked up by a 64-bit hash of the block so that texts are shuffled once. Hashes that two different
blocks share are found when the blocks are numbered, and those blocks are looked up by their content.

Defined results: null text counts as empty, and all empty texts are one group; a null id sorts after all
others and may be the keep_id of a group that has no other; rows equal in id and text are all kept if their
id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import stored, text_of

BLOCK_BYTES = 8192


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def _blocks(docs: DataFrame, block_bytes: int, block_hash: Callable[[Column], Column]) -> DataFrame:
    """A row for each block: the document's key and figures, idx, blocks (of the document), h, block."""
    texts = docs.select("doc_id", F.length(text_of()).cast("long").alias("n_chars"), normalised(text_of()).cast("binary").alias("__b"))
    parts = F.greatest(F.lit(1), F.ceil(F.octet_length("__b") / F.lit(block_bytes))).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                      lambda i: F.substring("__b", i * block_bytes + 1, F.lit(block_bytes)))
    rows = (texts.withColumns({"text_sha256": F.sha2("__b", 256), "blocks": parts})
            .select("doc_id", "n_chars", "text_sha256", "blocks", F.posexplode(cut).alias("idx", "block")))
    return rows.withColumn("h", block_hash(F.col("block")))


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Sorted inside each partition and numbered; each number is given once in the whole table."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _first_names(blocks: DataFrame) -> DataFrame:
    """blocks with the names of their contents, without the contents."""
    names = stored(_numbered(blocks.select("h", "block").distinct(), "h", "block").select("h", "name"))
    shared = names.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    if shared.isEmpty():
        return blocks.drop("block").join(names, "h").drop("h")
    shared = stored(shared)  # as good as never: hashes of several blocks, which only their content tells apart
    alone = blocks.drop("block").join(names.join(shared, "h", "left_anti"), "h").drop("h")
    among = blocks.join(shared, "h", "left_semi")
    by_content = _numbered(among.select("block").distinct(), "block").withColumn("name", -F.col("name") - 1)
    return alone.unionByName(among.join(by_content, "block").drop("h", "block"))


def _identities(first: DataFrame) -> DataFrame:
    """doc_id, text_sha256, level and name of each document of more than one block."""
    rest = first.where("blocks > 1").select("doc_id", "text_sha256", "blocks", "idx", "name")
    done, level = [], 1
    most = rest.agg(F.max("blocks")).first()[0] or 1
    while most > 1:
        pairs = stored(rest.groupBy("doc_id", "text_sha256", "blocks", F.floor(F.col("idx") / 2).cast("int").alias("pair")).agg(
            F.max(F.when(F.col("idx") % 2 == 0, F.col("name"))).alias("a"),
            # names begin at 0, those by content are negative: this one is never given
            F.coalesce(F.max(F.when(F.col("idx") % 2 == 1, F.col("name"))), F.lit(-(1 << 63))).alias("b")))
        names = stored(_numbered(pairs.select("a", "b").distinct(), "a", "b"))
        named = pairs.join(names, ["a", "b"]).select(
            "doc_id", "text_sha256", F.ceil(F.col("blocks") / 2).cast("int").alias("blocks"), F.col("pair").alias("idx"), "name")
        rest, most, level = stored(named), (most + 1) // 2, level + 1
        done.append(rest.where("blocks = 1").select("doc_id", "text_sha256", F.lit(level).alias("level"), "name"))
        rest = rest.where("blocks > 1")
    if not done:
        return rest.select("doc_id", "text_sha256", F.lit(0).alias("level"), "name").limit(0)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
                     block_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of each document.

    Of equal texts, the row with the most code points in its original text stays, then the smallest doc_id.
    """
    first = stored(_first_names(_blocks(docs, block_bytes, block_hash)))
    head = first.where("idx = 0")
    one = head.where("blocks = 1").select("doc_id", "n_chars", "text_sha256", F.lit(1).alias("level"), "name")
    i, d = _identities(first).alias("i"), head.where("blocks > 1").alias("d")
    several = (d.join(i, F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("d.text_sha256") == F.col("i.text_sha256")))
               .select("d.doc_id", "d.n_chars", "d.text_sha256", "i.level", "i.name"))
    known = stored(one.unionByName(several))
    best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("id")))
    groups = stored(known.groupBy("level", "name").agg(best["id"].alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return known.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
