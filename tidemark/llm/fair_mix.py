"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, gone through up to ``cap`` times.
A copy of a document finishes at virtual time (source words up to and including it) / (target of
the source), so that all sources reach their target at time 1.  All copies are put in one global
order by finish time and taken until the budget, the total of all sizes, is used up.

Nothing is sorted in one place.  Running sums have two levels: shuffled documents of a source
fall into ``BUCKETS`` ranges of a hash, whose sums are added up per source, and rows are only
ordered within (source, range).  For the global order the time axis is cut into ranges; whole
ranges before the cut are taken unsorted, and only the range the budget runs out in is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_of, written

#: Hash ranges of a source.  A third of 40 billion documents makes 3 million rows in each.
BUCKETS = 4096
#: Time ranges in one unit of virtual time; times from 2 on share the last range.
RANGES = 8192
WORDS = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size) -> with weight and target.

    ``sources`` has one row per source: a dimension table, ordered in one task.  Weights repeat
    over the sources in code point order, null last.  Targets share the total by weight; where
    one would exceed ``cap`` x its source's size it stops there, and the rest is shared again
    by the others.  That is a water level: with sources by cap / weight, the level is the first
    at which the source it meets isn't capped."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * cap)
    fill = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    s = s.withColumn("level", left.cast("double") / F.sum("weight").over(after))
    met = F.when(F.col("most") >= F.col("level") * F.col("weight"), F.col("level"))
    s = s.withColumn("level", F.min_by(met, F.when(met.isNotNull(), F.col("most") / F.col("weight")))
                     .over(everything))
    return s.select("source", "source_size", "weight",
                    F.least(F.col("most").cast("double"), F.col("level") * F.col("weight"))
                    .alias("target"))


def finish(copy: Column) -> Column:
    """Virtual finish time of a document's copy number ``copy`` (from 0)."""
    return (copy * F.col("source_size") + F.col("upto")).cast("double") / F.col("target")


def time_range(v: Column) -> Column:
    return F.floor(F.least(v, F.lit(2.0)) * RANGES)


def fair_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3,
             seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text; of other columns those in ``carry`` stay):
    doc_id, source, size, source_size, weight, target, copies, taken.

    Null text: size 0.  Null source: a source of its own, last.  Null doc_id: shuffled as the
    empty text.  Repeated rows are documents of their own; ties end in doc_id.  Documents of
    size 0 are never taken.  Empty table: empty result.  Nothing is random: reruns agree."""
    spark = docs.sparkSession
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = written(docs.select(
        "doc_id", "source", *carry, F.regexp_count(text_of(), F.lit(WORDS)).cast("bigint").alias("size"),
        key.alias("key")).withColumn("bucket", F.conv(F.substring("key", 1, 3), 16, 10).cast("int")),
        "mix-sized")
    shelves = sized.groupBy("source", "bucket").agg(F.sum("size").alias("shelf"))
    shelves = written(shelves, "mix-shelves")
    aims = targets(shelves.groupBy("source").agg(F.sum("shelf").alias("source_size")), weights, cap)
    started = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shelves = shelves.withColumn("started", F.coalesce(F.sum("shelf").over(started), F.lit(0)))
    aims = aims.withColumnRenamed("source", "aim")
    shelves = (shelves.join(aims, F.col("source").eqNullSafe(F.col("aim"))).drop("aim", "shelf")
               .withColumnsRenamed({"source": "of", "bucket": "at"}))
    inside = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, 0))
    placed = (sized.withColumn("inside", F.sum("size").over(inside))
              .join(shelves, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at")))
              .withColumn("upto", F.col("started") + F.col("inside"))
              .select("doc_id", "source", *carry, "size", "source_size", "weight", "target", "key", "upto"))
    placed = written(placed, "mix-placed")

    copies = (placed.filter("size > 0").withColumn("copy", F.explode(F.array(*map(F.lit, range(cap)))))
              .withColumn("v", finish(F.col("copy"))).withColumn("range", time_range(F.col("v"))))
    ranges = copies.groupBy("range").agg(F.sum("size").alias("words"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    budget = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # at most 2 * RANGES + 1 rows: ordered in one task; one row comes to the driver
    met = (ranges.withColumn("upto", F.sum("words").over(upto)).filter(F.col("upto") > budget)
           .orderBy("range").select("range", "upto", "words").first())
    cut = None
    if met is not None:
        order = Window.orderBy("v", "key", "doc_id", "copy").rowsBetween(Window.unboundedPreceding, 0)
        last = F.max(F.struct("v", "key", "doc_id", "copy"))
        cut = (copies.filter(F.col("range") == met["range"])
               .withColumn("run", F.sum("size").over(order) + (met["upto"] - met["words"]))
               .filter(F.col("run") <= budget).agg(last.alias("last")).first()["last"])

    def taken(copy: int) -> Column:
        if met is None:
            return F.lit(0)
        v = finish(F.lit(copy))
        inside = F.lit(False)
        if cut is not None:
            here = F.struct(v.alias("v"), F.col("key").alias("key"), F.col("doc_id").alias("doc_id"),
                            F.lit(copy).alias("copy"))
            there = F.struct(F.lit(cut["v"]).alias("v"), F.lit(cut["key"]).alias("key"),
                             F.lit(cut["doc_id"]).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
                             F.lit(cut["copy"]).alias("copy"))
            inside = here <= there
        where = time_range(v)
        return F.when(F.col("size") == 0, 0).when(where < met["range"], 1).when(
            (where == met["range"]) & inside, 1).otherwise(0)

    n = sum((taken(c) for c in range(cap)), F.lit(0))
    return placed.select("doc_id", "source", *carry, "size", "source_size", "weight", "target",
                         n.cast("bigint").alias("copies"), (n * F.col("size")).cast("bigint").alias("taken"))
