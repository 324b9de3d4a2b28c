"""Content-addressed web archive: payload bytes once per strong digest, exact record headers beside them.

``write_archive`` keeps two Parquet tables below one folder:

* ``payloads``: one row per distinct payload, keyed by its SHA-256, with its SHA-1, length and the largest page id that
  carries it;
* ``records``: one row per page with the exact bytes of its WARC/1.1 head (named fields, blank line, HTTP head) and the
  key of its payload.

``read_records`` joins them again, checks every payload against its key and every head against its payload, and gives
the full record bytes. Of records with equal payloads of at least ``revisit_from`` bytes the one with the largest page
id is a response and the others are revisits of it; smaller payloads are always responses (their bytes are still
stored once).

Null html is an empty payload. A null url leaves out the target field; line breaks in a url are percent-encoded. Rows
that share the largest page id of their payload are all responses, as nothing tells them apart; a null id is below all
others and has the record id ``<urn:page:null>``. Ids are whole numbers, or text if the reader is told so. Extra columns are ignored. An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
#: Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
URN = "<urn:page:"


def _payload(html_col: str) -> Column:
    return F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")


def _record_id(page_id: Column) -> Column:
    """A text id is percent-encoded, and the text ``null`` so that it differs from a null id."""
    name = F.url_encode(page_id.cast("string"))
    return F.concat(F.lit(URN), F.coalesce(F.when(name == "null", F.lit("%6Eull")).otherwise(name), F.lit("null")), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A named field, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _head(date: str) -> Column:
    """The exact head of a record: WARC fields, blank line and the HTTP head that precedes the payload."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    revisits = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")) & F.col("long_enough")
    carried = F.when(revisits, F.lit(0)).otherwise(F.col("payload_bytes"))
    uri = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.when(revisits, REVISIT).otherwise(RESPONSE),
        F.lit(CRLF),
        _field("WARC-Record-ID", _record_id(F.col("page_id"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", uri),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Refers-To", F.when(revisits, _record_id(F.col("top")))),
        _field("WARC-Profile", F.when(revisits, F.lit(PROFILE))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        (F.octet_length(http) + carried).cast("string"),
        F.lit(CRLF * 2),
        http,
    )


def write_archive(
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    revisit_from: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write the archive of ``pages`` below ``root``, which must not exist yet."""
    spark = pages.sparkSession
    keyed = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), _payload(html_col).alias("payload")
    ).withColumn("payload_key", F.unhex(F.sha2("payload", 256)))
    keyed.groupBy("payload_key").agg(F.first("payload").alias("payload"), F.max("page_id").alias("top")).select(
        "payload_key",
        "top",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "payload",
    ).write.parquet(f"{root}/payloads")
    known = spark.read.parquet(f"{root}/payloads").select("payload_key", "top", "payload_bytes", "payload_digest")
    (
        keyed.select("page_id", "url", "payload_key")
        .join(known, "payload_key")
        .withColumn("long_enough", F.col("payload_bytes") >= revisit_from)
        .select("payload_key", F.encode(_head(date), "UTF-8").alias("head"))
        .write.parquet(f"{root}/records")
    )


def _named(head: Column, name: str) -> Column:
    """The value of a field, null where the head lacks it. Only CR LF ends a line, and written values hold neither."""
    found = F.regexp_extract(head, f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _page_id(head: Column, name: str, id_type: str) -> Column:
    uri = _named(head, name)
    given = F.when(uri != f"{URN}null>", F.url_decode(uri.substr(F.lit(len(URN) + 1), F.length(uri) - len(URN) - 1)))
    found = given.try_cast(id_type)
    return _checked(given.isNull() | found.isNotNull(), found, f"a page id is no {id_type}")


def _checked(ok: Column, value: Column, fault: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(fault)))


def read_records(spark: SparkSession, root: str, id_type: str = "bigint") -> DataFrame:
    """The records of an archive: fields read from the heads, ``payload`` and the full bytes in ``record``.

    A payload that doesn't match its key, a head that names another digest, or an id that is not of ``id_type`` raises.
    """
    payloads = spark.read.parquet(f"{root}/payloads").select(
        "payload_key",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        _checked(
            F.unhex(F.sha2("payload", 256)) == F.col("payload_key"), F.sha1("payload"), "a payload doesn't match its digest"
        ).alias("payload_digest"),
    )
    text = F.decode(F.col("head"), "UTF-8")
    heads = spark.read.parquet(f"{root}/records").select(
        "payload_key",
        "head",
        _named(text, "WARC-Type").alias("record_type"),
        _page_id(text, "WARC-Record-ID", id_type).alias("page_id"),
        _named(text, "WARC-Target-URI").alias("url"),
        _page_id(text, "WARC-Refers-To", id_type).alias("refers_to"),
        _named(text, "WARC-Payload-Digest").alias("named_digest"),
    )
    joined = heads.join(payloads, "payload_key")
    body = F.when(F.col("record_type") == RESPONSE, F.col("payload")).otherwise(F.lit(b""))
    return joined.select(
        "page_id",
        "url",
        "payload_bytes",
        _checked(
            F.col("named_digest") == F.concat(F.lit("sha1:"), F.col("payload_digest")),
            F.col("payload_digest"),
            "a record names another digest than its payload has",
        ).alias("payload_digest"),
        "record_type",
        "refers_to",
        "head",
        "payload",
        F.concat(F.col("head"), body, F.lit((CRLF * 2).encode())).alias("record"),
    )
