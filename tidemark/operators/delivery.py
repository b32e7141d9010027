"""Delivery correctness: duplicate audit, keep-first dedup, dedup across runs,
crash replay, resume from committed offsets.

Everything keyed is an aggregation by key with map-side partial aggregation:
a key holding a third of the log collapses to one partial row per map task
before the shuffle.  Keys compare null-safe (a null key is one key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

_FIRST = "_tm_first"


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def duplicate_audit(log: DataFrame, key: str) -> DataFrame:
    """One row: processed (all deliveries), unique_rides (distinct keys, a
    null key counting once) and duplicates (the difference)."""
    k = F.col(key)
    has_null = F.max(k.isNull().cast("int"))
    out = log.agg(F.count(F.lit(1)).alias("processed"),
                  (F.count_distinct(k) + F.coalesce(has_null, F.lit(0))).cast("bigint")
                  .alias("unique_rides"))
    return out.withColumn("duplicates", F.col("processed") - F.col("unique_rides"))


def keep_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order``; remaining columns break ties, so the
    choice is deterministic even when rows sharing a key differ."""
    ks = _keys(keys)
    rest = [c for c in df.columns if c not in ks and c not in order]
    first = F.min(F.struct(*order, *rest)).alias(_FIRST)
    picked = df.groupBy(*ks).agg(first)
    return picked.select(*ks, *[F.col(f"{_FIRST}.{c}").alias(c) for c in [*order, *rest]]) \
        .select(*df.columns)


def _packed(df: DataFrame, order: Sequence[str]) -> Column | None:
    """Two integer columns as one number in the same order, nulls first; null
    where the columns are of other types.  A number is a hash aggregate's
    buffer, a struct makes it sort."""
    kinds = [df.schema[c].dataType for c in order]
    if len(order) != 2 or not all(isinstance(k, (IntegerType, LongType)) for k in kinds):
        return None
    high, low = (F.coalesce(F.col(c).cast("decimal(20,0)"), F.lit(_NONE).cast("decimal(20,0)"))
                 for c in order)
    return (high * F.lit(_SPAN).cast("decimal(18,0)") + low).cast("decimal(38,0)")


_SPAN, _NONE = 10 ** 17, -(10 ** 16)   # offsets below 10^16 keep their order


def _first_of(df: DataFrame, order: Sequence[str]) -> Column:
    packed = _packed(df, order)
    return packed if packed is not None else F.struct(*order)


def _unpacked(first: Column, df: DataFrame, order: Sequence[str]) -> list[Column]:
    if _packed(df, order) is None:
        return [first[c].alias(c) for c in order]
    span = F.lit(_SPAN).cast("decimal(18,0)")
    # the low part lies in [_NONE, _SPAN + _NONE)
    high = F.floor((first - F.lit(_NONE).cast("decimal(20,0)")) / span)
    low = first - high * span
    return [F.when(v != _NONE, v.cast(df.schema[c].dataType)).alias(c)
            for v, c in zip((high.cast("decimal(20,0)"), low.cast("decimal(20,0)")), order)]


def flag_duplicates(df: DataFrame, keys: str | Sequence[str], order: Sequence[str],
                    out_col: str = "is_duplicate") -> DataFrame:
    """Every row, flagged true unless it is the first of its key.

    The first order value per key is found by partial aggregation and joined
    back null-safe; a hot key is split by AQE's skew-join handling instead of
    being ranked in one task.
    """
    ks = _keys(keys)
    firsts = df.groupBy(*ks).agg(F.min(_first_of(df, order)).alias(_FIRST))
    firsts = firsts.select(*[F.col(k).alias(f"_tm_k_{k}") for k in ks], _FIRST)
    cond = [df[k].eqNullSafe(firsts[f"_tm_k_{k}"]) for k in ks]
    joined = df.join(firsts, cond, "inner")
    return joined.select(*df.columns, (_first_of(df, order) != F.col(_FIRST)).alias(out_col))


def _cogroup(rows: DataFrame, known: Column, key: str, order: Sequence[str]) -> DataFrame:
    """Per key of ``rows`` (key and order columns), of which those that are
    ``known`` are the seen set and the others the input: known, n_in, first."""
    return rows.groupBy(key).agg(
        F.max(known).alias("known"), F.count_if(~known).alias("n_in"),
        F.min(F.when(~known, _first_of(rows, order))).alias(_FIRST))


def dedup_flagged(rows: DataFrame, known: Column, key: str, order: Sequence[str]) -> DataFrame:
    """``dedup_against_seen`` for one table that holds both sides, told apart
    by ``known``: one pass, one shuffle, one number per key in its buffer."""
    new = _cogroup(rows, known, key, order).where(~F.col("known") & (F.col("n_in") > 0))
    return new.select(key, *_unpacked(F.col(_FIRST), rows, order))


def summary_flagged(rows: DataFrame, known: Column, key: str, order: Sequence[str]) -> DataFrame:
    """``run_summary`` for one table that holds both sides."""
    return _summary(_cogroup(rows, known, key, order))


def _both(incoming: DataFrame, seen_keys: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    seen = seen_keys.select(F.col(key), *[F.lit(None).cast(incoming.schema[c].dataType).alias(c)
                                          for c in order], F.lit(True).alias("_tm_known"))
    return seen.unionByName(incoming.select(key, *order, F.lit(False).alias("_tm_known")))


def dedup_against_seen(incoming: DataFrame, seen_keys: DataFrame, key: str,
                       order: Sequence[str]) -> DataFrame:
    """Rows to process in this run: the first incoming row of every key that
    is not in ``seen_keys`` (a null key is one key).  The seen set and the
    input are co-grouped in one shuffle (no separate anti join + dedup);
    columns beside key and order make the rows themselves the buffer."""
    rest = [c for c in incoming.columns if c != key and c not in order]
    if not rest:
        rows = _both(incoming, seen_keys, key, order)
        return dedup_flagged(rows, F.col("_tm_known"), key, order).select(*incoming.columns)
    row_type = incoming.select(F.struct(*order, *rest).alias("r")).schema["r"].dataType
    seen = seen_keys.select(F.col(key), F.lit(True).alias("_tm_known"),
                            F.lit(None).cast(row_type).alias("_tm_row"))
    inc = incoming.select(F.col(key), F.lit(False).alias("_tm_known"),
                          F.struct(*order, *rest).alias("_tm_row"))
    new = seen.unionByName(inc).groupBy(key).agg(
        F.max("_tm_known").alias("known"), F.min("_tm_row").alias(_FIRST)).where(~F.col("known"))
    return new.select(F.col(key), *[F.col(f"{_FIRST}.{c}").alias(c) for c in [*order, *rest]]) \
        .select(*incoming.columns)


def run_summary(incoming: DataFrame, seen_keys: DataFrame, key: str,
                order: Sequence[str]) -> DataFrame:
    """One row: known_before (distinct seen keys), processed (new keys taken),
    skipped (incoming rows not taken: known keys and in-run repeats)."""
    return _summary(_cogroup(_both(incoming, seen_keys, key, order), F.col("_tm_known"), key, order))


def _summary(g: DataFrame) -> DataFrame:
    processed = F.count_if(~F.col("known") & (F.col("n_in") > 0))
    out = g.agg(F.count_if(F.col("known")).alias("known_before"),
                processed.alias("processed"),
                F.coalesce(F.sum("n_in"), F.lit(0)).cast("bigint").alias("_n"))
    return out.select("known_before", "processed",
                      (F.col("_n") - F.col("processed")).alias("skipped"))


def crash_replay(log: DataFrame, off_col: str, processed_upto: int | Column,
                 committed: int | Column) -> DataFrame:
    """What a restarted consumer sees after processing offsets below
    ``processed_upto`` but committing only ``committed``: the first run's
    rows plus everything from the committed offset again."""
    o = F.col(off_col)
    times = F.array_repeat(F.lit(1), (o < processed_upto).cast("int") + (o >= committed).cast("int"))
    return log.withColumn("_tm_time", F.explode(times)).drop("_tm_time")


def replay_audit(log: DataFrame, key: str, off_col: str, processed_upto: int | Column,
                 committed: int | Column) -> DataFrame:
    """Naive vs idempotent consumer over a crash replay, side by side."""
    a = duplicate_audit(crash_replay(log, off_col, processed_upto, committed), key)
    return a.select(F.col("processed").alias("naive_processed"),
                    F.col("unique_rides").alias("idempotent_processed"),
                    F.col("duplicates").alias("double_processed"))


def resume_from_offsets(log: DataFrame, committed: DataFrame, part_col: str,
                        off_col: str, committed_col: str = "committed") -> DataFrame:
    """Rows at or after the committed offset of their partition; a partition
    with no commit is read from the start.  ``committed`` holds one row per
    log partition; AQE broadcasts it where it measures it small."""
    c = committed.select(F.col(part_col).alias("_tm_p"), F.col(committed_col).alias("_tm_c"))
    j = log.join(c, log[part_col].eqNullSafe(c["_tm_p"]), "left")
    return j.where(F.col(off_col) >= F.coalesce(F.col("_tm_c"), F.lit(0))) \
        .select(*log.columns)


def incremental_run(incoming: DataFrame, seen_path: str, key: str, order: Sequence[str],
                    out_path: str, run_id: str, key_type: str = "string") -> DataFrame:
    """One run of dedup across runs, with its state saved.

    Loads the seen keys (empty the first time), keeps the first incoming row
    of every new key, writes those rows as this run's partition of
    ``out_path`` and then their keys as this run's partition of the seen
    table.  Both writes replace the run's partition, so a run repeated after
    a crash neither loses keys nor writes rows twice.  Returns the rows
    written.
    """
    from tidemark.sources.seen import RUN_COL, load_seen, save_seen

    spark = incoming.sparkSession
    seen = load_seen(spark, seen_path, key, key_type, before_run=run_id)
    fresh = dedup_against_seen(incoming, seen, key, order)
    fresh.withColumn(RUN_COL, F.lit(run_id)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(RUN_COL).parquet(out_path)
    written = spark.read.parquet(out_path).where(F.col(RUN_COL) == run_id).drop(RUN_COL)
    save_seen(written.select(key), seen_path, run_id)
    return written


def stored_run(incoming: DataFrame, store, key: str, order: Sequence[str], out_path: str,
               run_id: str) -> DataFrame:
    """``incremental_run`` against a ``KeyStore``: the saved keys are joined where
    they lie, bucket by bucket; only the run's own rows are dealt.

    A run repeated after a crash replaces its rows and keys, as long as no other
    run has followed it.  Returns the rows written.
    """
    from tidemark.sources.keystore import not_in_store
    from tidemark.sources.seen import RUN_COL

    spark = incoming.sparkSession
    store.check(run_id)
    read, _ = store.state()
    fresh = not_in_store(keep_first(incoming, key, order), key, store.keys(without_run=run_id))
    place = f"{out_path.rstrip('/')}/{RUN_COL}={run_id}"
    fresh.write.mode("overwrite").parquet(place)  # also where nothing is new
    written = spark.read.schema(fresh.schema).parquet(place)
    store.commit(run_id, written.select(key), read)
    store.merge()
    return written
