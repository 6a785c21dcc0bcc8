"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.operators.joins import BROADCAST_BYTES, WORD_BITS, lookup
from postmill.session import written

# monotonically_increasing_id puts the partition number above this bit and the
# position in the partition below it.
POSITION_BITS = 33


def dense_ids(rows: DataFrame, order_by: list[str], id_name: str, after: int = 0) -> DataFrame:
    """Number rows after+1, after+2, ... in ascending order of order_by (nulls first).

    The order columns must tell all rows apart. Rows are range partitioned and
    sorted, then written with their partition and position, so that ids do not
    depend on a recomputation. Only one count per partition is brought together
    for the offsets, and that many rows is all that is broadcast.
    """
    placed = written(
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftright("_place", POSITION_BITS))
    position = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    so_far = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_rows")).select("_part", so_far.alias("_offset"))
    number = (F.lit(after + 1) + F.col("_offset") + position).cast("long")
    return placed.join(F.broadcast(offsets), "_part").select(number.alias(id_name), *rows.columns)


def next_ids(target: DataFrame, new_rows: DataFrame, order_by: list[str], id_name: str) -> DataFrame:
    """Number new rows after the highest id in target, as an auto-increment column would."""
    highest = target.agg(F.coalesce(F.max(id_name), F.lit(0))).first()[0]
    return dense_ids(new_rows, order_by, id_name, after=highest)


PLACE = ["_file", "_start", "_place"]


def with_places(scan: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows of a file scan with the file, the piece of it and a counter that rises within the piece."""
    return scan.select(
        *(columns or ["*"]),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"),
    )


def file_row_ids(scan: DataFrame, id_name: str = "job_id") -> DataFrame:
    """Number rows with places 1, 2, ... in file name order, then file order.

    A task reads the pieces of files it was given one after the other, so position
    follows from the row counter alone; rows are neither shuffled nor sorted.
    """
    return placed_row_ids(written(scan, "file-rows"), id_name)


def placed_row_ids(placed: DataFrame, id_name: str = "job_id") -> DataFrame:
    """`file_row_ids` of a written table that holds every row of a scan with its place."""
    pieces = dense_pieces(placed)
    kept = [c for c in placed.columns if c not in PLACE]
    return lookup(placed, pieces, ["_file", "_start"]).select(
        (F.col("_place") - F.col("_first") + F.col("_offset") + 1).cast("long").alias(id_name), *kept
    )


def dense_pieces(placed: DataFrame) -> DataFrame:
    """Per piece of a file: its first row counter and the rows in pieces before it.

    Offsets are added up in two steps, within a file and over files, so no step
    sees more rows than one file has pieces or the input has files.
    """
    pieces = placed.groupBy("_file", "_start").agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    in_file = Window.partitionBy("_file").orderBy("_start")
    pieces = pieces.withColumn("_before", F.sum("_rows").over(in_file) - F.col("_rows"))
    files = pieces.groupBy("_file").agg(F.sum("_rows").alias("_in_file"))
    earlier = F.sum("_in_file").over(Window.orderBy("_file")) - F.col("_in_file")
    files = files.select("_file", earlier.alias("_earlier"))
    pieces = pieces.join(files, "_file").withColumn("_offset", F.col("_earlier") + F.col("_before"))
    return written(pieces.select("_file", "_start", "_first", "_offset"), "file-pieces")


#: Words of a block, and blocks whose rows are summed up together, as powers of two.
BLOCK_BITS = 6
SPAN_BITS = 12


def _low_bits(number: Column, bits: int) -> Column:
    return number.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def picked_rows(
    rows: DataFrame, picked: DataFrame, place: str, id_name: str, after: int = 0, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows whose place is in `picked` (place, copies), as often as it says, numbered after+1, after+2, ... in order of place.

    Places are dense whole numbers, one per row, and `picked` holds each once. They are held as bits with the number of rows
    before every 64 of them, which is less than half a byte per place, and broadcast if that fits. Then no row is
    shuffled or sorted; beyond the limit rows are shuffled once. Both are read more than once: pass written tables.
    """
    blocks = _picked_blocks(picked, place)
    number, word = F.col(place), _low_bits(F.shiftright(place, WORD_BITS), BLOCK_BITS)
    met = lookup(rows.withColumn("_block", F.shiftright(number, WORD_BITS + BLOCK_BITS)), blocks, ["_block"], limit=limit)
    at = _low_bits(number, WORD_BITS)
    bits, more = F.get("_bits", word), F.get("_more", word)
    below = bits.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), at)))

    def copies(which: Callable[[Column], Column]) -> Column:
        """Copies beyond the first, of the word's places that are told so."""
        told = F.aggregate(F.filter(more, lambda m: which(m["at"])), F.lit(0).cast("long"), lambda n, m: n + m["more"])
        return F.when(more.isNull(), F.lit(0).cast("long")).otherwise(told)

    first = F.get("_before", word) + F.bit_count(below) + copies(lambda other: other < at) + after + 1
    kept = [c for c in rows.columns if c != place]
    met = met.where(F.getbit(bits, at) == 1)
    counted = met.select(first.cast("long").alias("_first"), F.explode(F.sequence(F.lit(0).cast("long"), copies(lambda other: other == at))).alias("_copy"), *kept)
    return counted.select((F.col("_first") + F.col("_copy")).alias(id_name), *kept)


def _picked_blocks(picked: DataFrame, place: str) -> DataFrame:
    """(_block, _bits, _before, _more): of every 64 words, the bits of the places in it, the rows before it and the places that hold several."""
    at = _low_bits(F.col(place), WORD_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at)
    word = F.shiftright(place, WORD_BITS).alias("_word")
    several = picked.where("copies > 1").groupBy(word)
    several = several.agg(F.collect_list(F.struct(at.alias("at"), (F.col("copies") - 1).alias("more"))).alias("_more"))
    words = picked.groupBy(word).agg(F.bit_or(bit).alias("_bits"), F.sum("copies").alias("_rows"))
    words = words.join(several, "_word", "left").withColumn("_block", F.shiftright("_word", BLOCK_BITS))
    within = F.sum("_rows").over(Window.partitionBy("_block").orderBy("_word")) - F.col("_rows")
    words = words.select("_block", "_rows", F.struct(_low_bits(F.col("_word"), BLOCK_BITS).alias("at"), "_bits", within.alias("before"), "_more").alias("_word"))
    blocks = written(words.groupBy("_block").agg(F.sum("_rows").alias("_rows"), F.collect_list("_word").alias("_words")), "picked-blocks")
    # Rows before a block are added up in two steps, within a span of blocks and over spans.
    span = F.shiftright("_block", SPAN_BITS).alias("_span")
    in_span = Window.partitionBy("_span").orderBy("_block")
    sums = blocks.select("_block", "_rows", span).withColumn("_in_span", F.sum("_rows").over(in_span) - F.col("_rows"))
    spans = blocks.groupBy(span).agg(F.sum("_rows").alias("_of_span"))
    spans = spans.select("_span", (F.sum("_of_span").over(Window.orderBy("_span")) - F.col("_of_span")).alias("_earlier"))
    offsets = sums.join(spans, "_span").select("_block", (F.col("_in_span") + F.col("_earlier")).alias("_offset"))
    # An element for every word, null where no place of it is picked.
    every = F.transform(F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda i: F.get(F.filter("_words", lambda w: w["at"] == i), F.lit(0)))
    blocks = blocks.join(offsets, "_block").select("_block", "_offset", every.alias("_words"))
    told = F.when(F.exists("_words", lambda w: w["_more"].isNotNull()), F.col("_words._more"))
    before = F.transform("_words", lambda w: w["before"] + F.col("_offset"))
    return written(blocks.select("_block", F.col("_words._bits").alias("_bits"), before.alias("_before"), told.alias("_more")), "picked-places")
