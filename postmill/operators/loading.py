"""Loads that leave existing rows alone, and rewrites that stand in for updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.dimensions import given_names
from postmill.operators.joins import BROADCAST_BYTES, fits_broadcast, lookup, without_ids
from postmill.operators.keys import next_ids
from postmill.operators.quality import duplicate_keys
from postmill.session import written


def one_per_key(batch: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per key: the smallest by all columns.

    Only keys are shuffled to find those that repeat; rows with a key of their own
    stay where they are. For the others min of a struct is combined before the
    shuffle, so copies of one key never meet in one task as they would in a window.
    Where so many keys repeat that they fit no broadcast, all rows with a key are grouped
    at once instead, which shuffles them one time. Rows without a key stay as they are.

    `batch` is read more than once: pass a written table.
    """
    repeated = written(duplicate_keys(batch, [key]).select(key), "repeated-keys")
    if fits_broadcast(repeated, limit):
        single = lookup(batch, repeated, [key], "left_anti", limit)
        several = lookup(batch, repeated, [key], "left_semi", limit)
    else:
        single, several = batch.where(F.col(key).isNull()), batch.where(F.col(key).isNotNull())
    rest = [c for c in batch.columns if c != key]
    kept = several.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*")
    return single.unionByName(kept)


def absent_rows(
    batch: DataFrame, target: DataFrame, key: str, unique: bool = False, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of batch, one per key, whose key is not in target; null keys are dropped.

    A batch whose keys fit a broadcast is checked by one scan of target's key
    column, without a shuffle of target. Rows that target holds are dropped first, so
    only new ones are made one per key. `unique` tells that no key repeats in batch.
    """
    batch = batch.where(F.col(key).isNotNull())
    keys = batch.select(key)
    held = target.select(key)
    if fits_broadcast(keys, limit):
        held = held.join(F.broadcast(keys), key, "left_semi")
    new = without_ids(batch, held, key, limit)
    return new if unique else one_per_key(new, key, limit)


def insert_absent(target: DataFrame, batch: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """New state of target after the insert."""
    return target.unionByName(absent_rows(batch, target, key, unique))


def insert_absent_names(dimension: DataFrame, source: DataFrame, name: str, id_name: str) -> DataFrame:
    """New state of a name dimension: unknown names get the next ids, in name order."""
    known = dimension.select(name)
    unknown = lookup(written(given_names(source, name), "names"), known, [name], "left_anti")
    return dimension.unionByName(next_ids(dimension, unknown, [name], id_name).select(*dimension.columns))


def with_empty_key(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.lit(None).cast("long"))


def backfill_key(
    rows: DataFrame, dimension: DataFrame, name: str, id_name: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Fill a foreign key where it is null, by name; keys already set stay."""
    found = dimension.select(name, F.col(id_name).alias("_found"))
    filled = lookup(rows, found, [name], "left", limit)
    return filled.withColumn(id_name, F.coalesce(id_name, "_found")).select(*rows.columns)


def without_deleted(rows: DataFrame, deleted: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows left after their parents in `deleted` are gone."""
    return lookup(rows, deleted.select(key).distinct(), [key], "left_anti", limit)
