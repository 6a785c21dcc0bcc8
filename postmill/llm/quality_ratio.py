"""Quality rules: fixed counts per text, and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed to BUCKETS buckets. Two multinomials over the buckets
are counted: the raw one over every document, the target over all trusted documents
(label quality 1, not toxic). A document's score is the mean, over its words and pairs,
of the log ratio of smoothed target and raw probability; one threshold holds for all.

Everything is SQL on built-in functions. Counts are combined before the shuffle to one
row per bucket and task. The log ratios, BUCKETS numbers, are one constant of the plan. Trusted
documents are told by bitmaps of their ids, which are broadcast within a measured size, so texts stay
where they are read; only ids too many and too scattered for that are joined by shuffle.

Defined cases: null text has no words and fails the base rules, as does any text below
50 words. Without trusted documents all ratios are 0 and only the base rules judge.
Rows without doc_id have no label. Repeated labels of a document count as trusted if
any says so. Repeated documents are judged and counted each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.words import text_of, words
from postmill.operators.joins import BROADCAST_BYTES, lookup
from postmill.session import written

BUCKETS = 1 << 14
SMOOTHING = 1.0
THRESHOLD = -0.06
LEAST_WORDS = 50

SYMBOL = r"[#*$%&|<>]"

# Bytes of one bitmap, which covers 32,768 ids.
BITMAP_BYTES = 4096


def bucket_of(buckets: int, *gram: Column) -> Column:
    """Bucket number of a word, or of a pair of words."""
    return F.pmod(F.xxhash64(*gram), F.lit(buckets)).cast("int")


def hashed_grams(own: Column, buckets: int) -> Column:
    """Bucket numbers of a word array's words and neighbouring pairs."""
    pairs = F.greatest(F.size(own) - 1, F.lit(0))
    single = F.transform(own, lambda w: bucket_of(buckets, w))
    return F.concat(single, F.zip_with(F.slice(own, 1, pairs), F.slice(own, 2, pairs), lambda a, b: bucket_of(buckets, a, b)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The doc_ids with a good label, each once."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").alias("good_id")).distinct()


def with_trust(rows: DataFrame, good: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """rows (doc_id, text) with good, 1 where doc_id is among the good_ids and else 0; null ids are not."""
    place = lambda c: (F.bitmap_bucket_number(c), F.bitmap_bit_position(c))
    bucket, bit = place(F.col("good_id"))
    maps = written(good.groupBy(bucket.alias("_map")).agg(F.bitmap_construct_agg(bit).alias("_bits")), "trusted-maps")
    if maps.count() * BITMAP_BYTES > limit:
        ids = written(good.select(F.col("good_id").alias("doc_id"), F.lit(1).alias("good")), "trusted-ids")
        return lookup(rows, ids, ["doc_id"], "left", limit).withColumn("good", F.coalesce("good", F.lit(0)))
    bucket, bit = place(F.col("doc_id"))
    met = rows.withColumns({"_map": bucket, "_bit": bit}).join(F.broadcast(maps), "_map", "left")
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.expr("shiftright(_byte, cast(_bit % 8 as int))").bitwiseAND(F.lit(1))
    return met.withColumn("_byte", byte).withColumn("good", F.coalesce(held, F.lit(0))).drop("_map", "_bit", "_bits", "_byte")


def gram_counts(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, raw and target: how often each bucket occurs in all documents and in trusted ones.

    Every word is made a row before it is hashed, alone and with the next one: Spark compiles
    hashes of rows, but interprets a function of an array's elements.
    """
    good = written(trusted_ids(labels), "trusted")
    marked = with_trust(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), good)
    own = marked.select("good", words(F.col("text")).alias("own"))
    # A plain posexplode gets a filter on the array's size, for which each text would be split twice.
    each = own.select("good", "own", F.posexplode_outer("own").alias("place", "word")).where("word is not null")
    word, after = F.col("word"), F.get("own", F.col("place") + 1)
    both = F.array(bucket_of(buckets, word), F.when(after.isNotNull(), bucket_of(buckets, word, after)))
    grams = each.select("good", F.explode(both).alias("bucket")).where("bucket is not null")
    return grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("target"))


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """Per bucket the log of target over raw probability."""
    counts = gram_counts(docs, labels, buckets).collect()
    raw_total = sum(r.raw for r in counts) + SMOOTHING * buckets
    target_total = sum(r.target for r in counts) + SMOOTHING * buckets
    if target_total == SMOOTHING * buckets:
        return [0.0] * buckets
    ratios = [math.log(raw_total / target_total)] * buckets
    for r in counts:
        ratios[r.bucket] = math.log((r.target + SMOOTHING) / target_total) - math.log((r.raw + SMOOTHING) / raw_total)
    return ratios


def base_counts(docs: DataFrame, keep: bool = False) -> DataFrame:
    """doc_id (as it is given if `keep`), words, the counts and base_failed of every document."""
    text = text_of()
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(
        F.col("doc_id") if keep else F.col("doc_id").cast("long").alias("doc_id"),
        words(text).alias("words"),
        lines.alias("lines"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
    )
    own = F.col("words")
    n = F.size(own)
    # A window's whole hash and its place: sorting brings equal windows together and
    # keeps their places.
    windows = F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(own, i), F.get(own, i + 1), F.get(own, i + 2))
    )
    second = first.select(
        "doc_id",
        "words",
        "n_symbols",
        n.cast("long").alias("n_words"),
        F.length(F.array_join(own, "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 4, windows).otherwise(F.array().cast("array<long>")).alias("windows"),
    )
    placed = F.transform("windows", lambda x, i: F.struct(x.alias("hash"), i.alias("place")))
    third = second.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    third = third.withColumn("sorted", F.when(F.col("repeats"), F.sort_array(placed)))
    at = F.col("sorted")
    head = lambda i: F.get(at, i)["hash"]
    twice = F.filter(F.sequence(F.lit(0), F.size(at) - 1), lambda i: (head(i) == head(i - 1)).eqNullSafe(True) | (head(i) == head(i + 1)).eqNullSafe(True))
    fourth = third.withColumn("places", F.when(F.col("repeats"), F.transform(twice, lambda i: F.get(at, i)["place"])))
    covered = F.array_distinct(F.concat(F.col("places"), F.transform("places", lambda p: p + 1), F.transform("places", lambda p: p + 2)))
    fifth = fourth.withColumn("n_repeat_words", F.when(F.col("repeats"), F.size(covered)).otherwise(0).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return fifth.select("doc_id", "words", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


def score(own: Column, ratios: list[float]) -> Column:
    """Mean log ratio over a word array's hashed grams (0 for no words)."""
    # Text split and cast is folded to one array constant by the optimizer.
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    grams = hashed_grams(own, len(ratios))
    total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(table, g))
    return F.when(F.size(own) > 0, total / (2 * F.size(own) - 1)).otherwise(0.0)


def settled(rows: DataFrame, *names: str) -> DataFrame:
    """rows with these columns as values, so that no filter on them is turned back into what made them.

    Without this a filter takes the place of each column by its expression, down to the text,
    and sorts a document's windows again for every word.
    """
    rest = [c for c in rows.columns if c not in names]
    return rows.select(*rest, F.inline(F.array(F.struct(*names))))


def scored(docs: DataFrame, ratios: list[float], threshold: float, keep: bool = False) -> DataFrame:
    """base_counts with score and kept, without the words."""
    counted = base_counts(docs, keep).withColumn("score", score(F.col("words"), ratios)).drop("words")
    counted = settled(counted, *[c for c in counted.columns if c != "doc_id"])
    return counted.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the counts, base_failed, score and kept of every document."""
    return scored(docs, log_ratios(docs, labels), threshold)


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, columns as given; rows are judged where they are read."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = docs.select(row.alias("doc_id"), "text")
    return scored(whole, log_ratios(docs, labels), threshold, keep=True).where("kept").select("doc_id.*")
