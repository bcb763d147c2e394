"""A content-addressed WARC archive.

The archive keeps two tables. ``payloads`` holds the bytes of each distinct payload once, named by
their SHA-256. ``headers`` holds every record's exact WARC and HTTP header bytes and the digest of
its payload. Records are rebuilt byte for byte by joining both on the digest, and bytes that do not
hash to their name raise an error.

Of records with equal payloads of at least ``least`` bytes the one with the smallest id is a
response, the others revisit it; smaller payloads are all responses. A null payload is the empty
one, a null id sorts last and gets a record id of its own from its URL and digest, a null URL
leaves the target header out. Rows that repeat an id are archived as records of their own; of
equal payloads under one smallest id all are responses. An empty table gives empty archives.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.operators.dedupe import dedupe_keep_first
from tamiz.session import materialize

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
ENCODING = "UTF-8"


def _record_id(page_id: Column, url: Column, digest: Column) -> Column:
    own = F.coalesce(page_id.cast("string"), F.concat(F.lit("none/"), F.coalesce(url, F.lit("")), digest))
    h = F.md5(own)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def plan_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 100
) -> DataFrame:
    """``page_id, url, payload_digest, payload_bytes, record_type, refers_to, refers_url`` of every page."""
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), ENCODING)
    plain = materialize(
        pages.select(
            F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.sha2(data, 256).alias("payload_digest"),
            F.octet_length(data).cast("long").alias("payload_bytes"),
        ),
        "warc-digests",
    )
    firsts = plain.filter(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("digest")).agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("known"),
    ).select("digest", F.col("known.page_id").alias("first_id"), F.col("known.url").alias("first_url"))
    joined = plain.join(firsts, F.col("payload_digest") == F.col("digest"), "left")
    again = F.col("digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "payload_digest", "payload_bytes",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
        F.when(again, F.col("first_url")).alias("refers_url"),
    )


def header_bytes(records: DataFrame, date: str) -> DataFrame:
    """Add ``warc_header`` and ``http_header``: the exact bytes of both, each with its closing empty line."""
    http = F.concat_ws(
        CRLF, F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.col("payload_bytes")), F.lit(""), F.lit(""),
    )
    revisit = F.col("record_type") == "revisit"
    length = F.octet_length("http_header") + F.when(revisit, 0).otherwise(F.col("payload_bytes"))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value)

    clean_url = F.regexp_replace("url", r"[\r\n]+", " ")
    with_http = records.withColumn("http_header", http)
    lines = [
        F.lit(VERSION),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"), F.col("payload_digest"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean_url),
        line("X-Page-ID", F.col("page_id").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, line("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("refers_url"), F.col("payload_digest")))),
        F.when(revisit, line("X-Refers-To-Page", F.col("refers_to").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        line("Content-Length", length.cast("string")),
        F.lit(""), F.lit(""),
    ]
    # concat_ws leaves out the lines that are null.
    with_warc = with_http.withColumn("warc_header", F.concat_ws(CRLF, *lines))
    return with_warc.withColumn("warc_header", F.encode("warc_header", ENCODING)).withColumn(
        "http_header", F.encode("http_header", ENCODING)
    )


def write_archive(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    least: int = 100, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write the tables ``payloads`` and ``headers`` below ``path`` (which has to be new)."""
    records = header_bytes(plan_records(pages, page_id, url, payload, least), date)
    records.select("warc_header", "http_header", "payload_digest").write.parquet(f"{path}/headers")
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), ENCODING)
    named = pages.select(F.sha2(data, 256).alias("payload_digest"), data.alias("payload"))
    # One row per digest leaves each task, however often a payload repeats.
    dedupe_keep_first(named, ["payload_digest"], "payload_digest").write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Rebuild the records: ``record`` (all bytes) with ``warc_header``, ``http_header`` and ``payload``.

    A revisit's payload is the one it refers to; its record ends after the HTTP header. A payload that
    is missing or does not hash to its name raises an error.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").withColumn("found", F.sha2("payload", 256))
    joined = headers.join(payloads, "payload_digest", "left")
    good = F.col("found").isNotNull() & (F.col("found") == F.col("payload_digest"))
    sound = F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload is missing or damaged: "), F.col("payload_digest"))).cast("binary")
    )
    kind = header_field(F.col("warc_header"), "WARC-Type")
    body = F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select(
        "warc_header", "http_header", "payload_digest", sound.alias("payload")
    ).withColumn(
        "record", F.concat("warc_header", "http_header", body, F.lit(b"\r\n\r\n"))
    )


def record_payload() -> Column:
    """The payload as a rebuilt ``record`` carries it, and for a revisit that of the record it refers to.

    A record whose block is not as long as its header says raises an error.
    """
    heads = F.octet_length("warc_header") + F.octet_length("http_header")
    block = F.substring(F.col("record"), heads + 1, F.octet_length("record") - heads - 4)
    told = header_field(F.col("warc_header"), "Content-Length").cast("long")
    sound = told == F.octet_length("http_header") + F.octet_length(block)
    revisit = header_field(F.col("warc_header"), "WARC-Type") == "revisit"
    wrong = F.raise_error("a record is not as long as its header says").cast("binary")
    return F.when(~sound, wrong).when(revisit, F.col("payload")).otherwise(block)


def header_field(header: Column, name: str) -> Column:
    """The value of a header line, null where there is none."""
    found = F.regexp_extract(F.decode(header, ENCODING), rf"(?:^|\r\n)\Q{name}\E: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def export_files(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write rebuilt ``record`` bytes as WARC files, several records after one another per file."""
    # Spark ends each line of text with the separator, here with the one that ends a WARC record.
    line = F.substring(F.col("record"), F.lit(1), F.octet_length("record") - 4).cast("string")
    writer = records.select(line.alias("value")).write.option("lineSep", "\r\n\r\n")
    writer.option("compression", compression).text(path)


def import_files(spark: SparkSession, path: str) -> DataFrame:
    """Read WARC files (plain or gzip) into ``warc_header``, ``block`` of every record, by content length.

    A file is read by one task; ``export_files`` writes one file per partition.
    """
    import gzip

    def parse(data: bytes):
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at) + 4
            head = data[at:end]
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n") if b": " in x)
            size = int(fields[b"Content-Length"])
            if data[end + size:end + size + 4] != b"\r\n\r\n":
                raise ValueError("a WARC record does not end where its length says")
            yield head, data[end:end + size]
            at = end + size + 4

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                data = data.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows = list(parse(data))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)], names=["warc_header", "block"]
                )

    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    return files.mapInArrow(run, "warc_header binary, block binary")
