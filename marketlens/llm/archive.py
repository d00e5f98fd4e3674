"""Content-addressed WARC archive: payloads once by digest, exact record headers apart, records by joins.

A payload's address is its SHA-256. The store holds each payload once; while it is made, rows that share an
address must agree in length and SHA-1, and whoever reads the store works its digests out again from the bytes.
Headers are kept as the exact bytes that stand before a payload in a WARC file: named fields and the HTTP
header block. A record is its header, for a response the payload that its address names, and two line
breaks. Of records with equal payloads one is the response; the others are revisits that refer to it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import shared_folder

from .common import private, table

END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RADIX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*groups), _RADIX, _BASE32)


def _one_line(text: Column) -> Column:
    """Line breaks would end a header field."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _urn(name: Column, number: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.url_encode(F.coalesce(name.cast("string"), F.lit(""))), F.lit(":"), number.cast("string"), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def header_bytes(date: str) -> Column:
    """What stands before the payload, from the columns of an index joined with its groups."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n")
    )
    revisit = F.col("refers_to").isNotNull()
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    fields = [
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _urn(F.col("page_id"), F.col("record_no"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _one_line(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Refers-To", F.col("refers_to")),
        _field("WARC-Profile", F.when(revisit, PROFILE)),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _field("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        http,
    ]
    return F.concat(*fields).cast("binary")


def write_archive(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write ``payloads`` (address, payload) and ``headers`` (page_id, address, header) into ``folder``.

    Of records with equal payloads of at least ``min_bytes`` bytes, the one with the smallest id is the response
    (no id comes last; among rows with that id, the first read), the others are revisits; smaller payloads are
    responses all, and still stored once. A null payload counts as empty. A null url leaves its field out, line
    breaks in it are written as %0D and %0A. Repeated rows make a record each. An empty table makes an empty
    archive. Other columns are ignored.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("payload"), F.lit("")).cast("binary")
    own = private(pages, page_id=id_col, url=url_col, payload=payload_col).withColumn("payload", payload).withColumn("address", F.unhex(F.sha2("payload", 256)))
    # equal payloads meet in the map tasks first, so a page that many share is sent once a task
    own.groupBy("address").agg(F.any_value("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{folder}/payloads")
    index = own.select(
        "page_id", "url", "address", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("sha1"),
        F.monotonically_increasing_id().alias("record_no"),
    )
    index.write.parquet(f"{folder}/index")
    index = spark.read.schema(index.schema).parquet(f"{folder}/index")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_no"))
    clash = (F.min("sha1") != F.max("sha1")) | (F.min("payload_bytes") != F.max("payload_bytes"))
    groups = (
        index.where(F.col("payload_bytes") >= min_bytes).groupBy("address")
        .agg(F.when(clash, F.raise_error(F.lit("two payloads share an address"))).otherwise(first).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("address", F.col("first.page_id").alias("first_id"), F.col("first.record_no").alias("first_no"))
    )
    refers = F.when(F.col("first_no") != F.col("record_no"), _urn(F.col("first_id"), F.col("first_no")))
    joined = index.join(groups, "address", "left").withColumn("refers_to", refers)
    joined.select("page_id", "address", header_bytes(date).alias("header")).write.parquet(f"{folder}/headers")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """(address, payload, payload_bytes, sha1), the digests worked out from the bytes read. A payload that is
    not what its address says is an error."""
    stored = spark.read.parquet(f"{folder}/payloads")
    address = F.unhex(F.sha2("payload", 256))
    checked = F.when(address == F.col("address"), address).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.hex("address"))))
    return stored.select(
        checked.alias("address"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("sha1")
    )


def _of_header(name: str, pattern: str) -> Column:
    """First group of a header field's value, null without the field. Fields start after a line break."""
    return F.nullif(F.regexp_extract(F.col("header").cast("string"), f"\r\n{name}: {pattern}\r\n", 1), F.lit(""))


def read_archive(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, header.

    Type, digest and reference come from the header; the bytes come from the store, joined by address, and their
    SHA-1 must be the header's. With ``with_payload`` the payload comes too, also for revisits, and
    ``record``: the exact bytes of the WARC record.
    """
    headers, store = spark.read.parquet(f"{folder}/headers"), read_payloads(spark, folder)
    kind = dict(headers.dtypes)["page_id"]
    refers = F.url_decode(_of_header("WARC-Refers-To", "<urn:x-page:([^:>]*):[0-9]+>")).cast(kind)
    parsed = headers.select(
        "page_id", "address", "header", _of_header("WARC-Type", "([a-z]+)").alias("record_type"),
        _of_header("WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("digest"), refers.alias("refers_to"),
    )
    joined = parsed.join(store if with_payload else store.drop("payload"), "address", "left")
    digest = F.when(F.col("sha1") == F.col("digest"), F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("no payload for digest "), F.col("digest"))))
    columns = ["page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to", "header"]
    if with_payload:
        block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
        columns += ["payload", F.concat("header", block, F.lit(END)).alias("record")]
    return joined.select(*columns)


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(fields, whole record, block) of WARC records that stand one after the other."""
    at = 0
    while at < len(data):
        head = data.index(END, at)
        lines = data[at:head].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = head + len(END)
        stop = start + int(fields["Content-Length"])
        if data[stop : stop + len(END)] != END:
            raise ValueError(f"record at byte {at} is cut")
        yield fields, data[at : stop + len(END)], data[start:stop]
        at = stop + len(END)


def op13_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as an archive and read back."""
    folder = shared_folder(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), folder)
    return read_archive(spark, folder).drop("header")


_GROUP_SQL = "list_reduce(list_transform(range(k * 5 + 1, k * 5 + 6), lambda i: instr('0123456789abcdef', substr(h, i, 1)) - 1), lambda a, b: a * 16 + b)"
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, strlen(html) AS payload_bytes, sha1(html) AS h FROM p),
b AS (SELECT page_id, html, payload_bytes, list_transform(range(8), lambda k: {_GROUP_SQL}) AS g FROM d),
s AS (SELECT page_id, html, payload_bytes,
  array_to_string(list_transform(range(32), lambda c: substr('{_BASE32}', ((g[c // 4 + 1] >> (15 - 5 * (c % 4))) & 31) + 1, 1)), '') AS payload_digest,
  min(page_id) OVER (PARTITION BY html) AS first_id FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM s
"""
