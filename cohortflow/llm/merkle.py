"""Operator 12, Merkle dataset manifest: pointer-jumping proofs.

Each row is a leaf: a digest of its columns. In each language leaves ascend by id and every ``FAN`` consecutive nodes
become one, until one is left, the subroot; subroots by language become the root in the same way. Then each inner
node points to its parent and holds one segment of sibling digests, those left and right of it. A self-join gives every
node its ancestor's pointer and segments in place of its own pointer: the distance doubles, segments are joined, and
after the logarithm of the tree's height all point to the root. Leaves take the last step: a run of leaves shares
its parent's segments, so these are held once for each run and not once for each leaf.

Places are dealt by a range-partitioned sort, so a language of a third of the rows is spread over many tasks, and
texts never move: only digests are shuffled.

Defined results: a null column hashes as ``-``; null and empty language are different ones, null comes first; leaves
of one id ascend by their digest, null ids come last; a null id is not tampered with; equal rows are leaves each, with
proofs of their own; the proof of a dataset of one row is the digest of the empty text; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import stored
from cohortflow.operators.windows import rank_within

FAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that are tampered with: those whose id's crc32 this divides.
TAMPERED = 3
#: The tree over the subroots; the languages' trees count from 0.
TOP = -1
NODE = ["tree", "level", "i"]


def digest(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def field(x: Column) -> Column:
    """One column of a leaf: the UTF-8 byte count, a colon, the value."""
    x = x.cast("string")
    return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return digest(F.concat(*(field(c) for c in columns)))


def _grown(base: DataFrame) -> DataFrame:
    """(n, tree, level, i, children) of every inner node, from the nodes (tree, n, i, h) of level 0.

    ``n`` is the number of nodes that the tree has on the level, ``children`` are the digests of the run below, in
    order. A tree grows until one node is left, so a tree of one node has no inner node.
    """
    nodes, level, out = base.select("tree", "n", F.lit(0).alias("level"), "i", "h"), 0, None
    most = base.agg(F.max("n")).first()[0] or 0
    while most > 1:
        runs = stored(nodes.where("n > 1").groupBy("tree", F.ceil(F.col("n") / FAN).alias("n"), F.lit(level + 1).alias("level"), F.floor(F.col("i") / FAN).alias("i"))
                      .agg(F.sort_array(F.collect_list(F.struct("i", "h"))).alias("run"))
                      .select("n", *NODE, F.col("run.h").alias("children")))
        out = runs if out is None else out.unionByName(runs)
        nodes = runs.select("n", *NODE, digest(F.array_join("children", "")).alias("h"))
        most, level = -(-most // FAN), level + 1
    return out if out is not None else nodes.select("n", *NODE, F.array("h").alias("children")).limit(0)


def _tops(grown: DataFrame, base: DataFrame) -> DataFrame:
    """(tree, level, h) of the last node of each tree."""
    lone = base.where("n = 1").select("tree", F.lit(0).alias("level"), "h")
    return lone.unionByName(grown.where("n = 1").select("tree", "level", digest(F.array_join("children", "")).alias("h")))


def _children(runs: DataFrame) -> DataFrame:
    """(tree, level, i) of each node of the runs, its parent (p_*) and its segment: the digests beside it."""
    k = F.col("k")
    side = lambda a, n: F.array_join(F.slice("children", a, n), "")
    return (runs.select("*", F.posexplode("children").alias("k", "h"))
            .select("tree", (F.col("level") - 1).alias("level"), (F.col("i") * FAN + k).alias("i"),
                    *(F.col(c).alias(f"p_{c}") for c in NODE),
                    F.array(F.struct(side(F.lit(1), k).alias("left"), side(k + 2, F.lit(FAN)).alias("right"))).alias("path")))


def _jumped(pointers: DataFrame, steps: int) -> DataFrame:
    """The nodes with all segments up to the root, after as many doublings as a path of ``steps`` takes."""
    reach = 1
    while reach < steps:
        ancestors = pointers.select(*(F.col(c).alias(f"p_{c}") for c in NODE), F.struct(*(F.col(f"p_{c}").alias(c) for c in NODE)).alias("next"),
                                    F.col("path").alias("more"))
        found = F.col("next").isNotNull()
        pointers = stored(pointers.join(ancestors, [f"p_{c}" for c in NODE], "left").select(
            *NODE, *(F.when(found, F.col(f"next.{c}")).otherwise(F.col(f"p_{c}")).alias(f"p_{c}") for c in NODE),
            F.when(found, F.concat("path", "more")).otherwise(F.col("path")).alias("path")))
        reach *= 2
    return pointers


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each document."""
    cols = {c: F.col(c) for c in COLUMNS}
    change = F.coalesce(F.crc32(cols["doc_id"].cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    lowered = cols | {"text": F.translate(cols["text"].cast("string"), UPPER, LOWER)}
    leaves = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), leaf_digest(list(cols.values())).alias("leaf"),
        F.when(change, leaf_digest(list(lowered.values()))).alias("tampered"))
    # ranks within a language, dealt by ranges of (language, id, digest)
    ranked = stored(rank_within(leaves, "lang", [F.col("doc_id").asc_nulls_last(), F.col("leaf")], "i").withColumn("i", F.col("i") - 1))
    langs = ranked.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0))
    trees = stored(rank_within(langs, "all", [F.col("lang").asc_nulls_first()], "tree").select("lang", "n", (F.col("tree") - 1).alias("tree")))
    t = trees.alias("t")
    ranked = ranked.join(t, ranked["lang"].eqNullSafe(F.col("t.lang"))).select(ranked["*"], "t.tree", "t.n")

    base = ranked.select("tree", "n", "i", F.col("leaf").alias("h"))
    grown = _grown(base)
    subroots = stored(_tops(grown, base))
    top_base = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(subroots.count()).cast("long").alias("n"), F.col("tree").alias("i"), "h")
    top = _grown(top_base)
    root = _tops(top, top_base).select(F.col("h").alias("root"))

    # a subroot is the same node as a leaf of the top tree: it takes that leaf's parent and segment
    upper = _children(top)
    of = subroots.select(F.col("tree").alias("i"), F.col("level").alias("sub_level"))
    joined = (upper.where("level = 0").join(of, "i").select(
        F.col("i").alias("tree"), F.col("sub_level").alias("level"), F.lit(0).cast("long").alias("i"), "p_tree", "p_level", "p_i", "path"))
    inner = _children(grown.where("level > 1")).unionByName(joined).unionByName(upper.where("level > 0"))
    heights = subroots.agg(F.max("level")).first()[0] or 0
    top_height = top.agg(F.max("level")).first()[0] or 0
    paths = _jumped(stored(inner), heights + top_height)

    # leaves: their run beside them, then what their parent holds; a lone leaf is a subroot itself
    sibling = lambda a, n: F.array_join(F.slice("children", a, n), "")
    place = (F.col("i") % FAN).cast("int")
    rows = (ranked.withColumns({"p": F.floor(F.col("i") / FAN)}).join(
        grown.where("level = 1").select("tree", F.col("i").alias("p"), "children"), ["tree", "p"], "left"))
    own = F.when(F.col("children").isNotNull(), F.array(F.struct(
        sibling(F.lit(1), place).alias("left"), sibling(place + 2, F.lit(FAN)).alias("right"))))
    above = paths.select("tree", F.col("level").alias("at"), F.col("i").alias("p"), F.col("path").alias("above"))
    none = F.array().cast("array<struct<left:string,right:string>>")
    rows = (rows.withColumn("at", F.when(F.col("children").isNotNull(), 1).otherwise(0)).join(above, ["tree", "at", "p"], "left")
            .withColumn("path", F.concat(F.coalesce(own, none), F.coalesce("above", none)))
            .join(subroots.select("tree", F.col("h").alias("subroot")), "tree"))
    proof = digest(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""))
    folded = F.aggregate("path", F.coalesce("tampered", "leaf"), lambda h, s: digest(F.concat(s["left"], h, s["right"])))
    out = rows.select("doc_id", "leaf", "subroot", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return (out.withColumn("root", F.lit(_value(root))).withColumn("verified", F.col("folded_root") == F.col("root"))
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


def _value(one: DataFrame) -> str | None:
    row = one.first()
    return row[0] if row else None
