"""Content-addressed WARC archive: payload bytes once, record headers apart.

Records go to two tables. `payloads` holds the bytes of each payload once, under their
SHA-256. `headers` holds, per record, its exact WARC and HTTP header bytes, the digest
and a sequence number. A record is rebuilt by joining the two; digests are verified
against the stored bytes when they are read.

Of records with equal payloads of at least `least_bytes` bytes the smallest page_id's is
the response and the others are revisits that name it; smaller ones are all responses.
Equal page_ids go by url, then in any order as they are alike. Null page_ids are last.

Payloads meet by digest with one row per task and digest, so many copies are no hot
group. Rows that agree in page_id, url and digest travel as one row with a count.

Defined cases: null html is an empty payload, null url an empty target. An empty table
makes empty archives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.session import scratch_path

LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex_digest: Column) -> Column:
    """Base32 of a hexadecimal digest whose bits are a multiple of 20, as SHA-1's are."""
    letters = []
    for i in range(8):
        # Five hex digits are 20 bits, four letters.
        value = F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(value, 15 - 5 * j).bitwiseAND(F.lit(31)) + F.lit(1), F.lit(1)) for j in range(4)]
    return F.concat(*letters)


def _lines(*fields: tuple[str, Column | str]) -> Column:
    parts: list[Column] = []
    for name, value in fields:
        if isinstance(value, str):
            parts.append(F.lit(f"{name}{value}\r\n"))
        else:
            # A field without a value is left out.
            parts.append(F.coalesce(F.concat(F.lit(name), value, F.lit("\r\n")), F.lit("")))
    return F.concat(*parts)


def write_archive(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write pages (page_id, url, html) as an archive below path."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    digested = given.withColumn("digest", F.unhex(F.sha2("payload", 256)))

    stored = digested.groupBy("digest").agg(F.min("payload").alias("payload"))
    stored.write.parquet(f"{path}/payloads")

    size = F.octet_length("payload").cast("long")
    narrow = digested.select("page_id", "url", "digest", base32(F.sha1("payload")).alias("sha1"), size.alias("size"))
    alike = narrow.groupBy("page_id", "url", "digest", "sha1", "size").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("page_id").isNull().alias("no_id"), F.col("page_id"), F.col("url"))
    first = alike.groupBy(F.col("digest").alias("of")).agg(F.min(order).alias("first"))
    named = alike.join(first, F.col("digest") == F.col("of")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    is_first = (F.col("copy") == 1) & F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("url") == F.col("first.url"))
    revisit = (F.col("size") >= least_bytes) & ~is_first
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    name = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.hex("digest"), F.md5("url"), F.col("copy").cast("string")))
    record_id = F.concat(*[F.concat(F.lit(mark), F.substring(name, at, n)) for mark, at, n in (("<urn:uuid:", 1, 8), ("-", 9, 4), ("-", 13, 4), ("-", 17, 4), ("-", 21, 12))], F.lit(">"))
    body = F.when(F.col("revisit"), F.octet_length("http")).otherwise(F.octet_length("http") + F.col("size"))
    refers = F.when(F.col("revisit"), F.concat(F.lit("<urn:page:"), F.coalesce(F.col("first.page_id").cast("string"), F.lit("none")), F.lit(">")))
    # A line break in a url would end its field early.
    target = F.regexp_replace("url", r"[\r\n]+", "%0D%0A")
    header = F.concat(
        _lines(
            ("WARC/1.1", ""),
            ("WARC-Type: ", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID: ", record_id),
            ("WARC-Date: ", DATE),
            ("WARC-Target-URI: ", target),
            ("WARC-Payload-Digest: sha1:", F.col("sha1")),
            ("WARC-Refers-To: ", refers),
            ("WARC-Profile: ", F.when(F.col("revisit"), F.lit(PROFILE))),
            ("Content-Type: ", "application/http; msgtype=response"),
            ("Content-Length: ", body.cast("string")),
        ),
        F.lit("\r\n"),
        F.col("http"),
    )
    records = named.withColumns({"revisit": revisit, "http": http})
    records.select("page_id", "digest", F.encode(header, "UTF-8").alias("header")).write.parquet(f"{path}/headers")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, digest, header bytes and the fields read from them."""
    text = F.decode("header", "UTF-8")
    field = lambda name: F.regexp_extract(text, rf"\r\n{name}: ?([^\r]*)\r\n", 1)
    refers = F.regexp_extract(field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1)
    return spark.read.parquet(f"{path}/headers").select(
        "page_id",
        "digest",
        "header",
        field("WARC-Type").alias("record_type"),
        F.regexp_extract(field("WARC-Payload-Digest"), r"sha1:(.*)", 1).alias("payload_digest"),
        F.when(refers != "", refers).cast("long").alias("refers_to"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads with their SHA-1 in base32; bytes that do not match their key raise."""
    stored = spark.read.parquet(f"{path}/payloads")
    good = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = F.when(good, F.octet_length("payload").cast("long")).otherwise(F.raise_error(F.lit("stored payload does not match its digest")).cast("long"))
    return stored.select(F.col("digest").alias("key"), "payload", checked.alias("payload_bytes"), base32(F.sha1("payload")).alias("sha1"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, checked against the payload."""
    facts = read_payloads(spark, path).select("key", "payload_bytes", "sha1")
    joined = read_headers(spark, path).join(facts, F.col("digest") == F.col("key"))
    same = F.when(F.col("sha1") == F.col("payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("header and payload digests differ")))
    return joined.select("page_id", "payload_bytes", same.alias("payload_digest"), "record_type", "refers_to")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, the record's original bytes, and its payload (a revisit's too)."""
    joined = read_headers(spark, path).join(read_payloads(spark, path), F.col("digest") == F.col("key"))
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    record = F.when(F.col("record_type") == "revisit", F.concat("header", end)).otherwise(F.concat("header", "payload", end))
    return joined.select("page_id", "record_type", record.alias("record"), "payload")


def archived(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write pages to an archive in the shared folder and read its index back."""
    path = scratch_path(pages.sparkSession, "archive")
    write_archive(pages, path, least_bytes)
    return read_index(pages.sparkSession, path)
