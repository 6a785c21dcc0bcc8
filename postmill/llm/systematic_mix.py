"""Mixing sources to target weights by systematic sampling.

Sources in code point order, null last, have the weights 3, 1, 2, 3, 1, 2 ... and share
a total in proportion to them. A source's target stops at twice its size, and what it
leaves is shared again by weight among the rest until none is above.

Within a source documents are ordered by size, and each expects target / size copies.
Expected copies are summed from the start of the source; a random offset of the source
is added, and a document is taken once for every whole number that its stretch of the
sum crosses. As neighbours are of like size, taken words come near the target, and as a
stretch is at most 2 long no document is taken more than twice.

The order of documents comes from a range partitioning on (source, size, ...), so a
source with a third of all rows is spread like any other; sums over partitions are
counts per (source, partition). Nothing depends on the partitioning, so reruns agree.

Defined cases: null text has size 0. A null source is a source. Rows that agree in
everything but their place have neighbouring places, whichever comes first; they are
alike, so results are the same rows. Documents of size 0 are taken like others of their
source and add nothing. A source without words has target 0. An empty table gives no
rows. Other columns are kept.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.words import text_of, word_count
from postmill.operators.keys import POSITION_BITS, dense_ids
from postmill.session import written

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MOST = 2
SEED = 20240229


def source_targets(sizes: DataFrame, share: Fraction = SHARE, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, size).

    Each round caps the sources that stand above their limit and shares what is left;
    only two sums per round reach the driver, however many sources there are.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Nulls last: a flag orders them behind every text.
    ranked = dense_ids(totals.select(F.col("source").isNull().alias("none"), "source", "source_size"), ["none", "source"], "rank")
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int"))
    ranked = written(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    whole = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = Fraction(0), -1
    limit = F.col("source_size") * most
    while True:
        # Capped: most * size < level * weight, in whole numbers.
        above = limit.cast("decimal(38,0)") * F.lit(level.denominator) < F.col("weight").cast("decimal(38,0)") * F.lit(level.numerator)
        row = ranked.agg(F.count_if(above), F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))).first()
        if row[0] == capped or not row[2]:
            break
        capped, level = row[0], (whole - (row[1] or 0)) / row[2]
    shared = F.col("weight") * F.lit(float(level))
    return ranked.select("source", "source_size", F.least(limit.cast("double"), shared).alias("target"))


def mixed(rows: DataFrame, share: Fraction = SHARE, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """Rows (source, size, mark, payload struct `row`) with source_size, target and copies (0 to `most`)."""
    targets = written(source_targets(rows.select("source", "size"), share, weights, most), "targets")
    order = ["none", "source", "size", "mark"]
    placed = rows.withColumn("none", F.col("source").isNull()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.select("source", "size", "row", F.monotonically_increasing_id().alias("place")), "placed")
    placed = placed.withColumn("at", F.shiftright("place", POSITION_BITS))
    # Before a row within its source: rows of earlier partitions, and rows since the source began in this one.
    parts = placed.groupBy("source", "at").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    parts = parts.withColumn("before", F.sum("rows").over(Window.partitionBy("source").orderBy("at")) - F.col("rows"))
    found = parts.join(targets, parts["source"].eqNullSafe(targets["source"]))
    found = found.select(parts["source"].alias("own"), F.col("at").alias("part"), "first", "before", "source_size", "target")
    place = F.col("before") + F.col("place") - F.col("first")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    upto = lambda n: F.floor(n * expected + offset)
    joined = placed.join(found, placed["source"].eqNullSafe(found["own"]) & (placed["at"] == found["part"]))
    return joined.select("row", "size", "source_size", "target", (upto(place + 1) - upto(place)).alias("copies"))


def _measured(docs: DataFrame, row: Column, seed: int = SEED) -> DataFrame:
    return docs.select("source", word_count(text_of()).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("mark"), row.alias("row"))


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target and taken (words, repeats counted).

    Texts are measured where they are read; only sizes travel.
    """
    result = mixed(written(_measured(docs, F.struct("doc_id")), "sizes"))
    return result.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix: every document as often as it is taken, columns as given."""
    result = mixed(_measured(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return result.where("copies > 0").select("row", times.alias("copy")).select("row.*")
