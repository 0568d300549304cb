"""WARC archives: write captures, read records back, and assemble them into one row per capture.

A capture is a response (or a revisit, when an equal payload is archived already) with its request and metadata
records, which name it as the record they are concurrent to. Archives are text files of Spark's
own writer whose line separator is the end of a WARC record, so they can lie wherever Spark can
write; each is compressed as a whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import new_folder

VERSION = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
#: Tasks that pages with one payload, and captures that refer to one page, are dealt to.
PARTS = 16
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_RECORD = (
    "type string, record_id string, concurrent_to string, target_uri string, date string, refers_to string,"
    " declared_digest string, http string, payload binary, payload_bytes long, payload_digest string"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(kind: str, page: object, digest: str) -> str:
    h = hashlib.md5(f"{kind} {page} {digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def _record(headers: dict[str, str | None], block: str) -> str:
    lines = [f"{k}: {v}" for k, v in headers.items() if v is not None]
    length = len(block.encode("utf-8", "replace"))
    return VERSION + "\r\n".join([*lines, f"Content-Length: {length}"]) + RECORD_END + block


def _capture(page: int | None, url: str | None, html: str, owner: int | None, digest: str) -> Iterator[str]:
    """Request, response or revisit, and metadata record of one page."""
    revisit = owner is not None and owner != page
    kind = "revisit" if revisit else "response"
    uri = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url) if url is not None else None
    own = _record_id("capture", page, digest)
    common = {"WARC-Date": DATE, "WARC-Target-URI": uri}
    target = re.sub(r"^[^:]*://[^/?#]*", "", uri or "") or "/"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html.encode('utf-8', 'replace'))}\r\n\r\n"
    yield _record({"WARC-Type": "request", "WARC-Record-ID": _record_id("request", page, digest), **common,
                   "WARC-Concurrent-To": own, "Content-Type": "application/http; msgtype=request"},
                  f"GET {target} HTTP/1.1\r\n\r\n")
    yield _record({"WARC-Type": kind, "WARC-Record-ID": own, **common, "WARC-Payload-Digest": f"sha1:{digest}",
                   "WARC-Refers-To": _record_id("capture", owner, digest) if revisit else None,
                   "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
                   "Content-Type": "application/http; msgtype=response"},
                  http if revisit else http + html)
    fields = f"page-id: {page}\r\n" if page is not None else "page-id:\r\n"
    yield _record({"WARC-Type": "metadata", "WARC-Record-ID": _record_id("metadata", page, digest), **common,
                   "WARC-Concurrent-To": own, "Content-Type": "application/warc-fields"}, fields)


def _part(*columns: str) -> Column:
    """One of ``PARTS`` that rows with one key are dealt to."""
    return F.pmod(F.xxhash64(*columns), F.lit(PARTS)).cast("int")


def _in_all_parts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 0) -> None:
    """Write three records per page below ``path``.

    Among pages with equal payloads of at least ``least_bytes`` bytes, the one with the largest id is a
    response and the others revisit it. A null payload is empty. A null id is smaller than any.
    Control characters of a URL are percent-encoded; a null URL is left out. Repeated rows are all
    written. An empty table writes no record.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).alias("url"), payload.alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("html"))).withColumn("part", _part("page", "url"))
    # a page that is the only one with its payload needs no owner; a payload of many pages is dealt to several tasks
    same = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest")
    owners = _in_all_parts(same.agg(F.max("page").alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n"))

    def records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out: list[str] = []
            for page, url, html, digest, owner in pdf[["page", "url", "html", "digest", "owner"]].itertuples(index=False):
                page, owner = (None if pd.isna(x) else int(x) for x in (page, owner))
                out.extend(_capture(page, url, html, owner, base64.b32encode(digest).decode()))
            yield pd.DataFrame({"value": out})

    written = rows.join(owners, ["digest", "part"], "left").select("page", "url", "html", "digest", "owner").mapInPandas(records, "value string")
    written.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def _headers(block: str) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.split("\r\n"))
    return {k.strip().lower(): v.strip() for k, colon, v in pairs if colon}


def _parse(record: str) -> dict:
    head, _, rest = record.partition(RECORD_END)
    h = _headers(head)
    block = rest.encode("utf-8", "replace")[: int(h["content-length"])]
    kind, http, payload = h.get("warc-type"), None, None
    if kind in ("request", "response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        http = http.decode("utf-8", "replace")
    elif kind == "metadata":
        payload = block
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    whole = kind == "response"
    return {
        "type": kind, "record_id": h.get("warc-record-id"), "concurrent_to": h.get("warc-concurrent-to"),
        "target_uri": h.get("warc-target-uri"), "date": h.get("warc-date"), "refers_to": h.get("warc-refers-to"),
        "declared_digest": digest, "http": http, "payload": payload if kind != "revisit" else None,
        "payload_bytes": len(payload) if whole else None, "payload_digest": sha1_base32(payload) if whole else None,
    }


def _complete(record: str) -> bool:
    head, end, rest = record.partition(RECORD_END)
    if not end:
        return False
    length = _headers(head).get("content-length")
    return length is None or len(rest) >= int(length) or len(rest.encode("utf-8", "replace")) >= int(length)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``.

    Files are cut at the version line that begins a record; what a payload holds of that line is put
    back together by the declared length. Compressed files are not split, so a task sees whole records.
    """
    lines = spark.read.option("lineSep", VERSION).text(path).select("value", F.col("_metadata.file_path").alias("file"))

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at = None, None
        for pdf in frames:
            out = []
            for piece, file in zip(pdf["value"], pdf["file"]):
                if file != at:
                    if held:
                        out.append(_parse(held))
                    held, at = None, file
                elif held is not None and not _complete(held):
                    held += VERSION + piece
                    continue
                if held:
                    out.append(_parse(held))
                held = piece or None
            if out:
                yield pd.DataFrame(out)
        if held:
            yield pd.DataFrame([_parse(held)])

    return lines.mapInPandas(parse, _RECORD)


def _field(payload: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(payload.cast("string"), rf"(?m)^{name}: *(.*?)\r?$", 1), F.lit(""))


def _captures(records: DataFrame) -> DataFrame:
    """Captures with their request and metadata, the response's fields still columns of their own.

    A struct that is built below a join is shuffled whole; as columns, payloads that nobody asks for stay where they lie.
    """
    captures = records.where(F.col("type").isin("response", "revisit")).select(
        "record_id", "type", "refers_to", "target_uri", "date", "http", "payload", "payload_bytes",
        F.coalesce("payload_digest", "declared_digest").alias("payload_digest"),
    )

    def beside(kind: str, *columns: Column | str) -> DataFrame:
        found = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        first = F.min(F.struct("record_id", *columns))
        return found.groupBy(F.col("concurrent_to").alias("record_id")).agg(first.alias(kind))

    return (
        captures.join(beside("request", "http", "target_uri"), "record_id", "left")
        .join(beside("metadata", F.col("payload").cast("string").alias("fields"), _field(F.col("payload"), "page-id").cast("long").alias("page_id")), "record_id", "left")
    )


def _nested(captures: DataFrame, *more: str) -> DataFrame:
    response = F.struct("http", "payload", "payload_bytes", "payload_digest").alias("response")
    return captures.select("record_id", "type", "refers_to", "target_uri", "date", response, "request", "metadata", *more)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record_id, type, request, response, metadata, refers_to``.

    Request and metadata records join the response or revisit they are concurrent to; of several
    the smallest by id counts; a capture without one has null there. Records that belong to no capture are left out.
    """
    return _nested(_captures(records))


def round_trip(pages: DataFrame, path: str | None = None, **names: str | int) -> DataFrame:
    """Archive pages, read the archives back, and return the assembled captures, revisits resolved.

    ``original``: the page and payload size of the response that a revisit refers to.
    """
    spark = pages.sparkSession
    path = path or new_folder(spark, "warc")
    write_archives(pages, path, **names)
    kept = new_folder(spark, "records")
    read_records(spark, path).write.option("compression", "zstd").parquet(kept)
    records = spark.read.schema(_RECORD).parquet(kept)
    captures = _captures(records)
    # what refers to nothing is dealt by its own id, what refers to one page to several tasks
    wanted = records.where("refers_to is not null").select(F.col("refers_to").alias("key")).distinct()
    originals = captures.where("type = 'response'").withColumnRenamed("record_id", "key").join(wanted, "key", "left_semi").groupBy("key").agg(
        F.min(F.struct(F.col("metadata.page_id").alias("page_id"), "payload_bytes")).alias("original")
    )
    dealt = captures.withColumns({"key": F.coalesce("refers_to", "record_id"), "part": _part("record_id")})
    dealt_originals = _in_all_parts(originals.withColumnRenamed("key", "original_key")).withColumnRenamed("part", "original_part")
    # a condition of the join, not a case behind it: the original stays a plain column, through which unused fields can be left out
    same = (F.col("key") == F.col("original_key")) & (F.col("part") == F.col("original_part")) & F.col("refers_to").isNotNull()
    return _nested(dealt.join(dealt_originals, same, "left"), "original")
