"""Connected components of verified links between the members of buckets, without all pairs of a bucket.

First each bucket names one member, that with the most companions, and tries it with all the others. Links merge
components, so a bucket whose members are alike is one component now, however large it is. In buckets that are not,
the members outside the largest component (strays) are then tried with every member of another component. In
buckets of up to ``SMALL`` members these pairs are rows; in larger ones strays and members meet in blocks of up to
about ``BLOCK`` each, and a task gives the links of its block alone. So every pair of a bucket has been tried or is
connected, no bucket is capped, and no task or node has the pairs of a large one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import ship, stored

SMALL, BLOCK = 64, 1024


def components(edges: DataFrame) -> DataFrame:
    """id and comp (the least id that can be reached) of all ids in the edges (a, b)."""
    both = stored(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a")).distinct())
    known = stored(both.groupBy(F.col("x").alias("id")).agg(F.least("id", F.min("y")).alias("comp")))
    while True:
        least = stored(
            both.join(known.select(F.col("id").alias("y"), "comp"), "y").select(F.col("x").alias("id"), "comp")
            .unionByName(known).groupBy("id").agg(F.min("comp").alias("comp")))
        jumped = least.join(least.select(F.col("id").alias("comp"), F.col("comp").alias("far")), "comp").select("id", F.col("far").alias("comp"))
        after = stored(jumped.join(known.withColumnRenamed("comp", "was"), "id"))
        known = after.select("id", "comp")
        if after.where("comp <> was").isEmpty():
            return known


def shared_only(members: DataFrame) -> DataFrame:
    """The rows (bucket, id) of buckets with two ids at least; a bucket streams through its task, sorted."""
    ship(members.sparkSession)

    def runs(batches):
        import numpy as np
        import pyarrow as pa

        held = None  # the bucket that the last batch ended in, its first id, and whether it has another
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, ids = (batch.column(c).to_numpy() for c in ("bucket", "id"))
            new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
            starts = np.flatnonzero(new)
            run = np.cumsum(new) - 1
            first = ids[starts]
            going_on = held is not None and held[0] == bucket[0]
            if going_on:
                first[0] = held[1]
            several = np.logical_or.reduceat(ids != first[run], starts)
            late = going_on and several[0] and not held[2]  # the first id was held back
            if going_on and held[2]:
                several[0] = True
            keep = several[run] & np.concatenate([[True], (ids[1:] != ids[:-1]) | new[1:]])
            out_b, out_i = bucket[keep], ids[keep]
            if late:
                out_b, out_i = np.append(out_b, held[0]), np.append(out_i, held[1])
            held = (int(bucket[-1]), int(first[-1]), bool(several[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(out_b), pa.array(out_i)], ["bucket", "id"])

    return (members.select("bucket", "id").repartition("bucket").sortWithinPartitions("bucket", "id")
            .mapInArrow(runs, "bucket long, id long"))


def linked(members: DataFrame, signs: DataFrame, plausible: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
           linked_pairs: Callable[[DataFrame], DataFrame], linked_blocks: Callable[[DataFrame], DataFrame],
           small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """id and comp (the least linked id) of all ids that share a bucket with another one.

    ``members`` has bucket and id (both long), ``signs`` more columns for each id. ``plausible`` tells from these,
    given as functions from a column's name to it, whether a pair may be linked; ``linked_pairs`` takes the pairs
    (a, b; a < b) that may and returns those that are. ``linked_blocks`` takes rows (block, bucket, id, comp, stray)
    and returns links (a, b) of strays and others of one block such that all linked components are connected.
    """
    more = [c for c in signs.columns if c != "id"]
    live = stored(shared_only(members))
    sizes = stored(live.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_bucket")))
    # those with many companions come first: they are likely to be what the others are copies of
    weight = live.join(sizes, "bucket").groupBy("id").agg(F.sum("n_bucket").alias("weight"))
    nodes = stored(weight.join(signs, "id"))
    now = stored(live.join(nodes, "id"))
    named = stored(now.select("bucket", F.struct(F.col("weight"), -F.col("id"), *(F.col(c).alias(f"o_{c}") for c in more)).alias("best"))
                   .groupBy("bucket").agg(F.max("best").alias("best"))
                   .select("bucket", (-F.col("best.col2")).alias("o_id"), *(F.col(f"best.o_{c}") for c in more)))
    # one leader for each bucket: at most as many pairs as there are members
    links = stored(linked_pairs(_pairs(now, named, plausible, F.lit(True))))
    comp = stored(_merged(nodes.select("id", F.col("id").alias("comp")), links))

    now = stored(now.join(comp, "id").join(named.select("bucket", F.col("o_id").alias("leader")), "bucket"))
    rest = now.where(F.col("id") != F.col("leader"))  # leaders have been tried with all
    by = rest.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"))
    open_ = stored(by.groupBy("bucket").agg(F.max(F.struct("k", "comp"))["comp"].alias("most"), F.sum("k").alias("n_bucket"),
                                            (F.sum("k") - F.max("k")).alias("strays")).where("strays > 0"))
    rest = stored(rest.drop("leader").join(open_, "bucket").withColumn("stray", F.col("comp") != F.col("most")).drop("most"))
    few, many = rest.where(F.col("n_bucket") <= small), rest.where(F.col("n_bucket") > small)
    strays = stored(few.where("stray").select("bucket", *(F.col(c).alias(f"o_{c}") for c in ("id", "comp", *more))))
    found = stored(linked_pairs(_pairs(few, strays, plausible, F.col("comp") != F.col("o_comp"))))
    across, down = F.ceil(F.col("strays") / block).cast("int"), F.ceil(F.col("n_bucket") / block).cast("int")
    row, column = F.pmod(F.xxhash64("id"), down).cast("int"), F.pmod(F.xxhash64("id", "bucket"), across).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    blocks = (many.select("bucket", "id", "comp", row.alias("i"), every(across).alias("j"), F.lit(False).alias("stray"))
              .unionByName(many.where("stray").select("bucket", "id", "comp", every(down).alias("i"), column.alias("j"), F.lit(True).alias("stray")))
              .select(F.xxhash64("bucket", "i", "j").alias("block"), "bucket", "id", "comp", "stray"))
    found = found.unionByName(stored(linked_blocks(stored(blocks))))
    return stored(_merged(comp, found))


def _pairs(members: DataFrame, others: DataFrame, plausible, which: Column) -> DataFrame:
    m, o = members.alias("m"), others.alias("o")
    return stored(m.join(o, (F.col("m.bucket") == F.col("o.bucket")) & (F.col("id") != F.col("o_id")) & which
                         & plausible(lambda c: F.col(f"m.{c}"), lambda c: F.col(f"o.o_{c}")))
                  .select(F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b")).distinct())


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components with those joined that a link joins."""
    ends = stored(links.join(comp.toDF("a", "ca"), "a").join(comp.toDF("b", "cb"), "b")
                  .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).where("a <> b").distinct())
    if ends.isEmpty():
        return comp
    return comp.join(components(ends).toDF("comp", "to"), "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))


def by_block(batches):
    """The rows of each block as a table, from batches sorted by block; a block may go on in the next batch."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        block = t.column("block").to_numpy()
        starts = [0, *((block[1:] != block[:-1]).nonzero()[0] + 1).tolist(), len(block)]
        for low, high in zip(starts, starts[1:], strict=False):
            part = t.slice(low, high - low)
            if held and pc.equal(held[0].column("block")[0], part.column("block")[0]).as_py() is False:
                yield pa.concat_tables(held)
                held = []
            held.append(part)
    if held:
        yield pa.concat_tables(held)
