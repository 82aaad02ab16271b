"""Legacy web archives: ARC files, their conversion to WARC, and reading either back."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm.common import broadcast_if_small, short_batches
from tiermill.session import written

# Fixed values of the two formats.
VERSION_1 = "1 0 archiver\nURL IP-address Archive-date Content-type Archive-length\n"
VERSION_2 = (
    "2 0 archiver\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset"
    " Filename Archive-length\n"
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"

# Records of a file, and bytes of a gzip file inflated at once.
FILE_RECORDS = 4000
CHUNK = 1 << 20


def _write(records: Column | DataFrame, path: str, end: str) -> None:
    """Each row's text as it is, with ``end`` after it, in gzip files of up to FILE_RECORDS records."""
    records.write.option("lineSep", end).option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(path)


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """``page_id``, ``url`` and ``html`` as ARC files of version 1 or 2; a null html is empty.

    A record is a line with the address, the time of capture and the length of what follows: the HTTP
    answer, whose headers carry the id. White space in addresses is escaped, as the line is split there.
    """
    html = F.coalesce("html", F.lit(""))
    length = F.octet_length(html)
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        length.cast("string"), F.lit(f"{CRLF}X-Page-Id: "), number, F.lit(CRLF * 2),
    )
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\s\p{C}]+", "%20")
    url = F.when(url == "", F.lit("-")).otherwise(url)
    seconds = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(300_000_000)) + 946_684_800
    date = F.date_format(F.timestamp_seconds(seconds), "yyyyMMddHHmmss")
    total = (F.octet_length(headers) + length).cast("string")
    fields = [url, F.lit("192.0.2.1"), date, F.lit("text/html")]
    if version == 2:
        checksum = F.md5(html.cast("binary"))
        fields += [F.lit("200"), checksum, F.lit("-"), F.lit("0"), F.lit("pages.arc.gz")]
    line = F.concat_ws(" ", *fields, total)
    record = F.concat(line, F.lit("\n"), headers, html).alias("record")
    # The file's own record: its length holds the version line and the list of fields.
    text = VERSION_1 if version == 1 else VERSION_2
    head = f"filedesc://pages.arc 192.0.2.1 20000101000000 text/plain {len(text)}\n{text}"
    if version == 2:
        head = (
            "filedesc://pages.arc 192.0.2.1 20000101000000 text/plain 200 - - 0 pages.arc.gz"
            f" {len(text)}\n{text}"
        )
    named = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) % FILE_RECORDS == 0
    _write(pages.select(F.when(named, F.concat(F.lit(head + "\n"), record)).otherwise(record)), path, "\n")


class Inflated:
    """A gzip file, inflated as it is read: lines, and blocks of a declared length."""

    def __init__(self, content: bytes):
        self.left, self.held, self.at = memoryview(content), b"", 0
        self.gzip = zlib.decompressobj(31)

    def _more(self) -> bool:
        while len(self.left):
            part = self.gzip.decompress(self.left[:CHUNK])
            rest = len(self.gzip.unused_data)
            self.left = self.left[min(CHUNK, len(self.left)) - rest :]
            if self.gzip.eof:  # files may hold a gzip member per record, and zeros after the last
                self.gzip = zlib.decompressobj(31)
                while len(self.left) and self.left[0] == 0:
                    self.left = self.left[1:]
            if part:
                self.held, self.at = self.held[self.at :] + part, 0
                return True
        return False

    def line(self) -> bytes | None:
        while (end := self.held.find(b"\n", self.at)) < 0:
            if not self._more():
                return None
        line, self.at = self.held[self.at : end + 1], end + 1
        return line

    def block(self, length: int) -> bytes:
        while len(self.held) - self.at < length:
            if not self._more():
                raise ValueError(f"a record ends {length - len(self.held) + self.at} bytes early")
        block, self.at = self.held[self.at : self.at + length], self.at + length
        return block


def arc_records(content: bytes) -> Iterator[dict]:
    """The records of an ARC file: a dictionary by the field names of its version, and the ``block``.

    The version line inside the first record tells whether header lines have five fields or ten.
    Fields are taken from the right, so that an address may hold blanks.
    """
    source, names = Inflated(content), None
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        fields = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        block = source.block(int(fields[-1]))
        if line.startswith(b"filedesc://"):
            names = block.split(b"\n")[1].decode().split()
            continue
        if names is None:
            raise ValueError("an ARC file starts with its own record")
        extra = len(fields) - len(names) + 1
        values = [" ".join(fields[:extra]), *fields[extra:]]
        yield dict(zip(names, values)) | {"block": block}


def _http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers by lower-case name, their bytes, and the payload: all of a block that is no HTTP answer."""
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    head, gap, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split(CRLF)[1:]
    return {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines)}, head + gap, payload


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


CONVERTED = (
    "record_id string, uri string, date string, mime string, page_id long, bytes long,"
    " digest string, head binary, payload binary"
)


def convert_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the ARC files below ``path``, with what a WARC record needs that they lack. Bytes
    are carried as they are, whatever they encode; without ``payloads`` these are null.

    ``record_id`` is a UUID made from the file, the place in it and the digest, the same whenever the
    file is read again; ``date`` is the archive date in ISO form; ``digest`` is the base32 SHA-1 of the
    payload. Records that are no HTTP answers (``dns:`` and the like) have an empty ``head`` and are
    payload as a whole. Lengths are those declared; a file that ends early is an error.
    """
    short_batches(spark, 8)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"]):
                rows = []
                for place, record in enumerate(arc_records(content)):
                    headers, head, payload = _http(record["block"])
                    digest = payload_digest(payload)
                    own = f"{name.rsplit('/', 1)[-1]}#{place}#{record['URL']}#{digest}"
                    when = datetime.strptime(record["Archive-date"], "%Y%m%d%H%M%S")
                    number = headers.get("x-page-id")
                    rows.append(
                        (
                            f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, own)}",
                            record["URL"],
                            when.replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
                            record["Content-type"],
                            int(number) if number else None,
                            len(payload),
                            digest,
                            head,
                            payload if payloads else None,
                        )
                    )
                    if len(rows) == 500:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(read, CONVERTED)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in CONVERTED.split(", ")])
    return frame.astype({"page_id": "Int64"})


def write_warc(
    records: DataFrame, path: str, least_bytes: int = 0, heads: DataFrame | None = None
) -> None:
    """Converted records as WARC 1.1 files. Of HTTP answers with equal payloads of at least
    ``least_bytes`` that with the smallest ``page_id`` (null last, then the smallest record id) is a
    response and the others are revisits of it, without the payload; smaller ones are responses. Other
    records are resources.

    Who is first is found among ``heads``, the same records, which need no payloads; only payloads that
    occur more than once are looked up, so the payloads of all rows are not shuffled as long as the list
    of these is small.
    """
    own = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "uri", "date")
    shared = (F.col("bytes") >= least_bytes) & (F.length("head") > 0)
    heads = records if heads is None else heads
    first = heads.filter(shared).groupBy(F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes")).agg(
        F.min(own).alias("first"), F.count(F.lit(1)).alias("_n")
    )
    # An id, two dates or so and an address a row; addresses differ in length.
    first = written(first.filter("_n > 1").drop("_n"), "first-records")
    longest = first.agg(F.max(F.octet_length("first.uri"))).first()[0] or 0
    first = broadcast_if_small(first, 400 + longest)
    same = (F.col("digest") == F.col("_digest")) & (F.col("bytes") == F.col("_bytes")) & shared
    joined = records.join(first, same, "left")
    revisit = F.coalesce(F.col("first.record_id") != F.col("record_id"), F.lit(False))
    http = F.length("head") > 0
    # Strings here are bytes that are written as they are.
    head, payload = F.col("head").cast("string"), F.col("payload").cast("string")
    block = F.when(revisit, head).otherwise(F.concat(head, payload))

    def named(name: str, value) -> Column:
        value = value if isinstance(value, Column) else F.lit(value)
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    refers = [
        named("WARC-Profile", REVISIT_PROFILE),
        named("WARC-Refers-To", F.concat(F.lit("<"), F.col("first.record_id"), F.lit(">"))),
        named("WARC-Refers-To-Target-URI", F.col("first.uri")),
        named("WARC-Refers-To-Date", F.col("first.date")),
    ]
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        named("WARC-Type", F.when(revisit, "revisit").when(http, "response").otherwise("resource")),
        named("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        named("WARC-Date", F.col("date")),
        named("WARC-Target-URI", F.col("uri")),
        named("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        named("WARC-Identified-Payload-Type", F.col("mime")),
        F.when(revisit, F.concat(*refers)).otherwise(F.lit("")),
        named("Content-Type", F.when(http, "application/http; msgtype=response").otherwise(F.col("mime"))),
        named("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
    )
    _write(joined.select(F.concat(header, block).alias("record")), path, CRLF * 2)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields by lower-case name, and the block, of every record of a WARC file."""
    source = Inflated(content)
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record starts with its version, not {line[:40]!r}")
        fields = {}
        while (line := source.line()) is not None and line.strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, source.block(int(fields["content-length"]))


READ = (
    "record_id string, record_type string, page_id long, payload_bytes long, payload_digest string,"
    " refers_to_id string, uri string, date string, payload string"
)


def read_warc(
    spark: SparkSession, path: str, payloads: bool = True, binary: bool = False
) -> DataFrame:
    """The records of the WARC files below ``path``; ``payload`` is null for revisits, and for all
    records without ``payloads``. It is text, with a replacement character for what is no UTF-8, or as
    it is with ``binary``. ``payload_bytes`` is that of the full payload. A response or resource whose
    payload does not have its digest is an error."""
    short_batches(spark, 8)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in READ.split(", ")]
        shown = bytes if binary else lambda payload: payload.decode("utf-8", "replace")
        for frame in frames:
            for content in frame["content"]:
                rows = []
                for fields, block in warc_records(content):
                    headers, _, payload = _http(block)
                    digest = fields["warc-payload-digest"].partition(":")[2]
                    response = fields["warc-type"] in ("response", "resource")
                    if response and payload_digest(payload) != digest:
                        raise ValueError(f"{fields['warc-record-id']} does not have its digest")
                    number = headers.get("x-page-id")
                    rows.append(
                        (
                            fields["warc-record-id"].strip("<>"),
                            fields["warc-type"],
                            int(number) if number else None,
                            len(payload) if response else int(headers["content-length"]),
                            digest,
                            fields.get("warc-refers-to", "").strip("<>") or None,
                            fields["warc-target-uri"],
                            fields["warc-date"],
                            shown(payload) if payloads and response else None,
                        )
                    )
                    if len(rows) == 500:
                        yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})
                        rows = []
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    schema = READ.replace("payload string", "payload binary") if binary else READ
    return files.select("content").mapInPandas(read, schema)


def with_referred_page(records: DataFrame) -> DataFrame:
    """Read records with ``refers_to``: the ``page_id`` of the response that a revisit refers to. They are
    read several times, so archives should be read and written before."""
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to")
    )
    referred = records.filter("refers_to_id IS NOT NULL").select("refers_to_id").distinct()
    responses = responses.join(referred, F.col("_id") == F.col("refers_to_id"), "left_semi")
    return records.join(responses, F.col("refers_to_id") == F.col("_id"), "left").drop("_id")
