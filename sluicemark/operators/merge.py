"""Upsert of a batch into a target by key, and its row counts."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicemark.session import resolve

ACTION = "_action"
INSERT, UPDATE, KEEP = "insert", "update", "keep"


def assert_unique_keys(source: DataFrame, keys: list[str]) -> None:
    """Error when two source rows share a key; rows with a null key never match and do not count.

    Counts combine on the map side, so a hot key costs one row per task.
    """
    names = resolve(source, keys)
    repeated = source.dropna(subset=names).groupBy(*names).count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"source has {repeated['count']} rows for key {[repeated[n] for n in names]}")


def _aligned(source: DataFrame, target: DataFrame, columns: list[str]) -> DataFrame:
    """Source columns in the target's order and types, renamed apart from the target's."""
    return source.select(
        *[
            F.col(f"`{own}`").cast(target.schema[c].dataType).alias(f"_s_{c}")
            for c, own in zip(columns, resolve(source, columns))
        ]
    )


def _on(keys: list[str], left: str = "", right: str = "_s_") -> Column:
    return reduce(and_, [F.col(f"`{left}{k}`") == F.col(f"`{right}{k}`") for k in keys])


def _has_null(names: list[str]) -> Column:
    return reduce(or_, [F.col(f"`{n}`").isNull() for n in names])


def heavy_keys(target: DataFrame, keys: list[str], tasks: int | None = None) -> list[int]:
    """Hashes of the keys that hold over a quarter of a task's even share of the rows, were they shuffled to ``tasks`` tasks.

    One pass over the key columns with a frequent-items sketch per task; there are at most 4 * ``tasks`` such keys.
    Counts are estimates, so a key near the limit may be on either side, which costs time and changes nothing.
    """
    names = [f"`{n}`" for n in resolve(target, keys)]
    tasks = tasks or int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(4 * tasks, 5_000)
    hashed = target.dropna(subset=[n.strip("`") for n in names]).select(F.xxhash64(*names).alias("_key"))
    found = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_key, {most}, {max(10_000, 2 * most)})").alias("top")).first()
    return [item["item"] for item in found["top"] or [] if item["count"] * most > found["n"]]


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    source_is_small: bool = False,
    with_action: bool = False,
    source_is_unique: bool = False,
    target_keys_repeat: bool = False,
    heavy: list[int] | None = None,
) -> DataFrame:
    """Target after the merge: matched rows take the source's values, unmatched source rows are added.

    Columns are the target's; extra source columns are ignored and missing ones are an error.
    A null key matches nothing.  The source must hold one row per key, which is checked by a job
    of its own unless ``source_is_unique`` vouches for it (a deduplicated batch).  It is read more
    than once, so stage a costly one first (``session.staged``).

    ``source_is_small`` (by measured size, see ``session.staged_with_size``) broadcasts the batch, so
    the target is not shuffled.  Otherwise rows with a null key, which match nothing, are set aside, and both
    sides shuffle once, for one full outer join by key.  Where a key may hold a large part of the target,
    ``target_keys_repeat`` joins twice instead, with the target on the side that adaptive execution can split.  Or name
    such keys in ``heavy`` (see ``heavy_keys``): their rows stay where they are and meet the few rows the batch has for them as a broadcast,
    and only the others are shuffled.
    """
    if not keys:
        raise ValueError("keys are required")
    if not source_is_unique:
        assert_unique_keys(source, keys)
    keys = resolve(target, keys)
    columns = target.columns
    batch = _aligned(source, target, columns)
    # The marker is a column of the batch side, so that it is null exactly where nothing matched.
    marked = batch.withColumn("_s_hit", F.lit(True))
    hit = F.col("_s_hit").isNotNull()
    inserted = [F.col(f"`_s_{c}`").alias(c) for c in columns]

    if heavy and not source_is_small:
        own_heavy = F.xxhash64(*[f"`{k}`" for k in keys]).isin(heavy)
        sent_heavy = F.xxhash64(*[F.col(f"`{own}`").cast(target.schema[k].dataType) for k, own in zip(keys, resolve(source, keys))]).isin(heavy)
        # The batch has one row per key, so its part for heavy keys is no longer than their list.
        few = upsert(target.where(own_heavy), source.where(sent_heavy), keys, source_is_small=True, with_action=True, source_is_unique=True)
        many = upsert(target.where(~own_heavy), source.where(~sent_heavy), keys, with_action=True, source_is_unique=True, target_keys_repeat=target_keys_repeat)
        result = few.unionByName(many)
        return result if with_action else result.drop(ACTION)

    if not source_is_small and not target_keys_repeat:
        aside = target.where(_has_null(keys)).withColumn(ACTION, F.lit(KEEP)).unionByName(
            batch.where(_has_null([f"_s_{k}" for k in keys])).select(*inserted, F.lit(INSERT).alias(ACTION))
        )
        held = target.where(~_has_null(keys)).withColumn("_t_hit", F.lit(True))
        joined = held.join(marked.where(~_has_null([f"_s_{k}" for k in keys])), _on(keys), "full_outer")
        action = F.when(F.col("_t_hit").isNull(), INSERT).when(hit, UPDATE).otherwise(KEEP)
        taken = [F.when(hit, F.col(f"`_s_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in columns]
        result = joined.select(*taken, action.alias(ACTION)).unionByName(aside)
        return result if with_action else result.drop(ACTION)

    hint = F.broadcast if source_is_small else (lambda df: df)
    merged = target.join(hint(marked), _on(keys), "left_outer").select(
        *[
            (F.col(f"`{c}`") if c in keys else F.when(hit, F.col(f"`_s_{c}`")).otherwise(F.col(f"`{c}`"))).alias(c)
            for c in columns
        ],
        F.when(hit, UPDATE).otherwise(KEEP).alias(ACTION),
    )
    present = target.select(*[F.col(f"`{k}`").alias(f"_t_{k}") for k in keys])
    if source_is_small:
        batch_keys = batch.select(*[f"`_s_{k}`" for k in keys])
        present = present.join(F.broadcast(batch_keys), _on(keys, "_t_"), "left_semi")
    present = present.distinct()  # at most one row per target key; no more rows than the batch if small
    added = batch.join(hint(present), _on(keys, "_t_"), "left_anti").select(*inserted, F.lit(INSERT).alias(ACTION))
    result = merged.unionByName(added)
    return result if with_action else result.drop(ACTION)


def merge_metrics(
    target: DataFrame, source: DataFrame, keys: list[str], source_is_small: bool = False, source_is_unique: bool = False
) -> DataFrame:
    """One row ``(rows_inserted, rows_updated)`` the merge would report; reads key columns only.

    Target keys are counted before the join, so many target rows of one key cost one row.  ``source_is_small`` (by
    measured size) keeps only target keys that the broadcast batch has before they are shuffled.
    """
    if not source_is_unique:
        assert_unique_keys(source, keys)
    keys = resolve(target, keys)
    batch = _aligned(source, target, keys)
    held = target.select(*[f"`{k}`" for k in keys])
    if source_is_small:
        held = held.join(F.broadcast(batch), _on(keys), "left_semi")
    held = held.groupBy(*[f"`{k}`" for k in keys]).agg(F.count(F.lit(1)).alias("_held"))
    joined = batch.join(held, _on(keys), "left_outer")
    return joined.agg(
        F.count(F.when(F.col("_held").isNull(), 1)).alias("rows_inserted"),
        F.coalesce(F.sum("_held"), F.lit(0)).cast("long").alias("rows_updated"),
    )


def read_metrics(result: DataFrame) -> tuple[int, int]:
    """The single ``(rows_inserted, rows_updated)`` pair; any other number of rows is an error."""
    rows = result.select("rows_inserted", "rows_updated").head(2)
    if len(rows) != 1:
        raise ValueError("merge result must hold exactly one row")
    return rows[0]["rows_inserted"], rows[0]["rows_updated"]
