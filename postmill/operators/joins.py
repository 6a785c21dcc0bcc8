"""Joins of a large table with a table of unknown size and skewed keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.session import written

# Largest side that is broadcast, by measured content.
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot if it holds more than 1/HOT_KEYS of the rows, so there are fewer
# than HOT_KEYS of them whatever the data.
HOT_KEYS = 10_000

ROW_OVERHEAD = 32


def content_bytes(df: DataFrame) -> int:
    """Measured size of df: lengths of texts, and of arrays as text, plus a fixed cost per row and column."""
    fixed = ROW_OVERHEAD + 16 * len(df.columns)
    texts = [F.col(c) for c, kind in df.dtypes if kind == "string"]
    texts += [F.to_json(c) for c, kind in df.dtypes if kind.startswith("array")]
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(t), F.lit(0)) for t in texts], F.lit(fixed).cast("long"))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return content_bytes(df) <= limit


def lookup(
    rows: DataFrame,
    other: DataFrame,
    keys: list[str],
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join rows with other on keys; how is inner, left, left_semi or left_anti.

    For inner and left, `other` holds each key once, as a dimension does. `other` is broadcast if its measured content is within the limit. Beyond it the
    rows are split by key frequency: rows with a hot key meet a broadcast of the
    hot part of `other`; the rest, where no key holds more than 1/hot_keys of the
    rows, is joined by shuffle. Both ways give the same rows.

    `other` and, for the split, `rows` are read more than once: pass written tables.
    Where rows are the result of earlier lookups, pass the table they began with as
    `counted`: keys are then counted there.
    """
    if fits_broadcast(other, limit):
        return rows.join(F.broadcast(other), keys, how)
    return _split_join(rows, other, keys, how, hot_keys, rows if counted is None else counted)


def _all_given(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _split_join(
    rows: DataFrame, other: DataFrame, keys: list[str], how: str, hot_keys: int, counted: DataFrame
) -> DataFrame:
    hot = written(hot_keys_of(counted, keys, hot_keys), "hot-keys")
    hot_other = other.join(F.broadcast(hot), keys, "left_semi")
    if how == "left":
        return _left_join(rows, other, hot.join(F.broadcast(hot_other), keys, "left"), keys)
    hot_match = hot.join(F.broadcast(hot_other), keys, how)
    settled = rows.join(F.broadcast(hot_match), keys, "left_semi" if how.startswith("left_") else "inner")
    cold = rows.join(F.broadcast(hot), keys, "left_anti")
    if how in ("inner", "left_semi"):
        met = cold.join(_hashed(other), keys, how)
    else:
        # Rows without a key match nothing but must stay: spread them over the
        # shuffle partitions instead of sending them all to one.
        spread = F.when(_all_given(keys), F.lit(0)).otherwise(F.xxhash64(*cold.columns))
        met = (
            cold.withColumn("_spread", spread.cast("long"))
            .join(_hashed(other.withColumn("_spread", F.lit(0).cast("long"))), [*keys, "_spread"], how)
            .drop("_spread")
        )
    return settled.unionByName(met)


def _hashed(other: DataFrame) -> DataFrame:
    """`other` as the side of a shuffled join that is hashed, so that the rows, which are wider, are not sorted.

    It holds a key once, or is only asked whether it does, so no partition of it is larger than its keys make it.
    """
    return other.hint("shuffle_hash")


def hot_keys_of(counted: DataFrame, keys: list[str], hot_keys: int) -> DataFrame:
    """Keys that hold more than 1/hot_keys of the rows."""
    total = counted.count()
    counts = counted.where(_all_given(keys)).groupBy(*keys).agg(F.count("*").alias("_rows"))
    return counts.where(F.col("_rows") * hot_keys > total).select(*keys)


def _left_join(rows: DataFrame, other: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which rows with a hot key get their match, or none, from a broadcast.

    Those, and rows without a key, go on under no key, spread over the shuffle partitions. `rows`
    stands in the plan once, so lookups one after the other read it once.
    """
    found = [c for c in other.columns if c not in keys]
    hot = hot.select(*keys, F.struct(F.lit(True).alias("hit"), *found).alias("_hot"))
    tagged = rows.join(F.broadcast(hot), keys, "left")
    alone = ~_all_given(keys) | F.col("_hot").isNotNull()
    spread = F.when(alone, F.xxhash64(*rows.columns)).otherwise(F.lit(0)).cast("long")
    cold = {f"_key_{i}": F.when(~alone, F.col(k)) for i, k in enumerate(keys)}
    names = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]
    right = other.select(*names, F.lit(0).cast("long").alias("_spread"), F.struct(F.lit(True).alias("hit"), *found).alias("_cold"))
    met = tagged.withColumns({**cold, "_spread": spread}).join(_hashed(right), [*cold, "_spread"], "left")
    value = F.coalesce("_hot", "_cold")
    order = [*keys, *[c for c in rows.columns if c not in keys]]
    return met.select(*order, *[value[c].alias(c) for c in found])


WORD_BITS = 6


def without_ids(rows: DataFrame, ids: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows whose key is none of ids, which may be null or repeat; rows without a key stay.

    Integer ids are held as words of 64 bits, one per 64 neighbours, and broadcast if these fit: at the worst
    a word per id, far less where ids are dense, as numbers given out in turn are. Then no row is shuffled. Beyond the
    limit, and for other keys, it is a `lookup`. `rows` is read more than once: pass a written table.
    """
    if dict(rows.dtypes)[key] not in ("int", "bigint"):
        return lookup(rows, written(ids.select(key), "known-ids"), [key], "left_anti", limit).select(*rows.columns)
    number = F.col(key).cast("long")
    word, place = F.shiftright(number, WORD_BITS), number.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    words = ids.where(F.col(key).isNotNull()).groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    words = written(words, "id-words")
    if not fits_broadcast(words, limit):
        return lookup(rows, written(ids.select(key), "known-ids"), [key], "left_anti", limit).select(*rows.columns)
    met = rows.withColumn("_word", word).join(F.broadcast(words), "_word", "left")
    return met.where(F.coalesce(F.getbit("_bits", place), F.lit(0)) == 0).select(*rows.columns)


def null_safe_lookup(
    rows: DataFrame,
    other: DataFrame,
    keys: dict[str, str],
    limit: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left lookup in which null equals null. `keys` maps columns of rows to columns of other.

    Each key becomes two columns that are never null, so hot keys, nulls among
    them, take the same ways as in `lookup`.
    """
    def given(columns: dict[str, str]) -> dict[str, Column]:
        pairs = {}
        for mine, name in columns.items():
            pairs[f"_{name}_null"] = F.col(mine).isNull()
            pairs[f"_{name}_text"] = F.coalesce(F.col(mine), F.lit(""))
        return pairs

    right = other.withColumns(given({theirs: theirs for theirs in keys.values()})).drop(*keys.values())
    helpers = list(given(keys))
    base = None if counted is None else counted.withColumns(given(keys))
    found = lookup(rows.withColumns(given(keys)), right, helpers, "left", limit, counted=base)
    return found.drop(*helpers)
