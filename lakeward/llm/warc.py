"""A content-addressed WARC archive: payload bytes once, exact record headers apart, records by join.

An archive is a folder with two Parquet tables:

* ``payloads``: address (SHA-256 of the bytes) and the payload, once for each distinct payload;
* ``records``: for each record its exact WARC and HTTP header bytes, and the payload's address.

A record is its header followed, unless it is a revisit, by the payload found under its
address. Reading checks each payload against its address, and each record against the lengths
and the digest that its own header states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the WARC format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RADIX_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"
_RECORD = "urn:page:"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of ``payload``, 20 bits of its hex form at a time."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _RADIX_32, BASE32)


def _page_key(page_id: Column) -> Column:
    return F.coalesce(page_id.cast("string"), F.lit(""))


def write_archive(pages: DataFrame, path: str, min_payload: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) below ``path``.

    The payload is the html in UTF-8; a null one is empty. Of records with equal payloads of at
    least ``min_payload`` bytes, those with the smallest page_id are responses and the others
    revisits of it; records of shorter payloads are responses. A null page_id is larger than any
    other; if a page_id repeats with one payload, its records are alike. Line ends in a url
    are percent-encoded, and a null url leaves out the header. Extra columns are not read.

    A payload that a third of all pages share is no hot key: only digests are grouped by
    address, combined before the shuffle, and payloads meet the chosen page by address and page.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("address", F.unhex(F.sha2("payload", 256)))
    firsts = rows.groupBy("address").agg(F.min("page_id").alias("first_id"))

    stored = rows.select("address", _page_key(F.col("page_id")).alias("page"), "payload")
    chosen = firsts.select("address", _page_key(F.col("first_id")).alias("page"))
    stored = stored.join(chosen, ["address", "page"], "left_semi").dropDuplicates(["address", "page"])
    stored.select("address", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")

    facts = rows.select(
        "page_id", "url", "address", F.octet_length("payload").alias("size"), sha1_base32(F.col("payload")).alias("digest")
    )
    judged = facts.join(firsts, "address")
    revisit = (F.col("size") >= min_payload) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    judged = judged.withColumn("revisit", revisit)
    judged.select(_header(date).alias("header"), "address").write.option("compression", "zstd").parquet(f"{path}/records")


def _header(date: str) -> Column:
    def line(name: str, *value: Column | str) -> Column:
        parts = [F.lit(v) if isinstance(v, str) else v.cast("string") for v in value]
        return F.concat(F.lit(f"{name}: "), *parts, F.lit(CRLF))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"), line("Content-Length", F.col("size")), F.lit(CRLF)
    )
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    revisit = F.concat(line("WARC-Profile", REVISIT_PROFILE), line("WARC-Refers-To", f"<{_RECORD}", F.col("first_id"), ">"))
    block = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))
    return F.encode(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}"),
            line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
            line("WARC-Record-ID", f"<{_RECORD}", _page_key(F.col("page_id")), ">"),
            line("WARC-Date", date),
            F.coalesce(line("WARC-Target-URI", url), F.lit("")),
            line("WARC-Payload-Digest", "sha1:", F.col("digest")),
            F.when(F.col("revisit"), revisit).otherwise(""),
            line("Content-Type", "application/http;msgtype=response"),
            line("Content-Length", block),
            F.lit(CRLF),
            http,
        ),
        "UTF-8",
    )


def verified_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads. A payload that does not have the digest it is stored under fails the read."""
    stored = spark.read.parquet(f"{path}/payloads")
    sound = F.unhex(F.sha2("payload", 256)) == F.col("address")
    failed = F.raise_error(F.concat(F.lit("damaged payload "), F.hex("address"))).cast("binary")
    return stored.select("address", F.when(sound, F.col("payload")).otherwise(failed).alias("payload"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records' headers, with what they say: page_id, record_type, refers_to, payload_digest, block_bytes, payload_bytes, url.

    block_bytes is the length stated in the WARC header, payload_bytes that in the HTTP header.
    """

    text = F.decode("header", "UTF-8")

    def said(name: str, pattern: str) -> Column:
        found = F.regexp_extract(text, f"(?:^|\r\n){name}: {pattern}\r\n", 1)
        return F.when(found != "", found)

    return spark.read.parquet(f"{path}/records").select(
        said("WARC-Record-ID", f"<{_RECORD}([^>]*)>").cast("bigint").alias("page_id"),
        said("WARC-Type", "([a-z]+)").alias("record_type"),
        said("WARC-Refers-To", f"<{_RECORD}([^>]*)>").cast("bigint").alias("refers_to"),
        said("WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("payload_digest"),
        said("Content-Length", r"(\d+)").cast("bigint").alias("block_bytes"),
        F.regexp_extract(text, "\r\nContent-Length: (\\d+)\r\n\r\n$", 1).cast("bigint").alias("payload_bytes"),
        said("WARC-Target-URI", "([^\r\n]*)").alias("url"),
        "address",
        "header",
    )


def _failing(what: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{what} of page "), _page_key(F.col("page_id"))))


def _whole(joined: DataFrame) -> DataFrame:
    """Headers with their ``payload`` as records; one without its payload fails the read."""
    payload = F.coalesce("payload", _failing("no payload").cast("binary"))
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    end = F.lit((CRLF * 2).encode())
    return joined.select("page_id", "record_type", "address", F.concat("header", body, end).alias("record"), payload.alias("payload"))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """Every record whole: page_id, record_type, address and ``record``, the bytes a WARC file holds for it, and its payload."""
    return _whole(records(spark, path).join(verified_payloads(spark, path), "address", "left"))


def payload_facts(whole: DataFrame) -> DataFrame:
    """Length and digest of the payload cut out of each reconstructed response: address, held_bytes, held_digest.

    The payload starts behind the second blank line, and the block ends two line ends before the record
    does. Several responses of one payload give one row.
    """
    # One character for each byte, so that places in the text are places in the record.
    text = F.decode("record", "ISO-8859-1")
    start = F.instr(text, CRLF * 2)
    block = F.expr("substring(record, _start + 4, octet_length(record) - _start - 7)")
    http = F.instr(F.decode("_block", "ISO-8859-1"), CRLF * 2)
    cut = whole.withColumn("_start", start).withColumn("_block", block).withColumn("_http", http)
    payload = F.expr("substring(_block, _http + 4, octet_length(_block))")
    facts = cut.select("address", F.octet_length(payload).cast("bigint").alias("held_bytes"), sha1_base32(payload).alias("held_digest"))
    return facts.groupBy("address").agg(F.min("held_bytes").alias("held_bytes"), F.min("held_digest").alias("held_digest"))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """What the archive holds of each page: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are reconstructed, and length and digest are taken from the payloads cut out of them. Every
    record, revisits too, meets those of its payload by address, so a payload that many pages share moves
    once. A record whose header states another digest, payload length or block length, or whose payload
    is missing, fails the read.
    """
    listed = records(spark, path)
    responses = listed.where("record_type = 'response'")
    facts = payload_facts(_whole(responses.join(verified_payloads(spark, path), "address", "left")))
    http = F.octet_length("header") - F.instr(F.decode("header", "ISO-8859-1"), CRLF * 2) - 3
    block = http + F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("held_bytes"))
    digest = (
        F.when(F.col("held_digest").isNull(), _failing("no payload"))
        .when(~F.col("payload_digest").eqNullSafe(F.col("held_digest")), _failing("wrong digest"))
        .when(~F.col("payload_bytes").eqNullSafe(F.col("held_bytes")), _failing("wrong payload length"))
        .when(~F.col("block_bytes").eqNullSafe(block), _failing("wrong block length"))
        .otherwise(F.col("held_digest"))
    )
    return listed.join(facts, "address", "left").select(
        "page_id", F.col("held_bytes").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to"
    )
