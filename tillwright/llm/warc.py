"""Conversion of legacy ARC archives to WARC, and reading WARC back.

An ARC archive opens with a version block whose header line ends in its length and whose body names the
version and the fields of all further header lines: five in version 1, ten in version 2. Every
record is such a line, and as many bytes as its last field declares: here an HTTP response.

The converter gives each record what WARC asks for: an identifier (a UUID drawn from the record's own
content, so that a task that runs again writes the same), a timestamp (from the 14-digit date), the type
(response, or revisit if another record holds the same payload) and SHA-1 digests of payload and
block. A revisit keeps the HTTP header and refers to the response; version blocks become warcinfo.

The first pass reads digests and ids only and finds the smallest id per digest, combined per task before
it is exchanged. In the second, records meet that id by a join on the digest, which adaptive execution
splits where one payload is very frequent.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# The field lists of the two versions of the format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_HEADER = "X-Record-Number"
#: An archive held in a cell ends after the record that takes it beyond so many bytes.
ARCHIVE_BYTES = 4 << 20

RECORDS = [
    ("kind", pa.string()), ("record_id", pa.string()), ("number", pa.int64()), ("url", pa.string()),
    ("ip", pa.string()), ("warc_date", pa.string()), ("head", pa.binary()), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("block_digest", pa.string()),
    ("head_digest", pa.string()),
]
RECORDS_DDL = (
    "kind STRING, record_id STRING, number BIGINT, url STRING, ip STRING, warc_date STRING, head BINARY,"
    " payload BINARY, payload_bytes BIGINT, payload_digest STRING, block_digest STRING, head_digest STRING"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def one_line(text: str | None) -> str:
    """A value that fits on a header line."""
    return (text or "-").replace("\r", "%0D").replace("\n", "%0A")


def http_response(number: int | None, html: bytes) -> bytes:
    own = f"{ID_HEADER}: {number}\r\n" if number is not None else ""
    return (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n{own}\r\n"
    ).encode() + html


def arc_opening(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 archive\n{FIELDS[version]}\n".encode()
    middle = "" if version == 1 else f"200 - - 0 {name} "
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {middle}{len(body)}\n".encode() + body


def arc_record(name: str, version: int, offset: int, url: str | None, date: str, block: bytes) -> bytes:
    middle = "" if version == 1 else f"200 {digest(block)} - {offset} {name} "
    return f"\n{one_line(url)} 127.0.0.1 {date} text/html {middle}{len(block)}\n".encode() + block


def arc_archives(pages: DataFrame, date: str = "19990101000000", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(content): pages as ARC archives in memory, in turn of version 1 and 2, records whole."""
    schema = pa.schema([("content", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            buffer, version, name = None, 1, ""
            for number, url, html in zip(
                batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("html")
            ):
                if buffer is None:
                    version, name = 1 + turn % 2, f"part-{turn:05d}.arc"
                    buffer, turn = bytearray(arc_opening(name, version, date)), turn + 1
                buffer += arc_record(name, version, len(buffer), url, date, http_response(number, html.as_py()))
                if len(buffer) >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bytes(buffer)], pa.binary())], schema=schema)
                    buffer = None
            if buffer is not None:
                yield pa.RecordBatch.from_arrays([pa.array([bytes(buffer)], pa.binary())], schema=schema)

    plain = common.pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        common.whole_text("html").cast("binary").alias("html"),
    )
    return common.in_arrow(plain, pack, "content BINARY")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """(content): the ARC archives under a path, plain or compressed member by member."""
    return spark.read.format("binaryFile").load(path).select("content")


def parse_arc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record, the version block first."""
    data = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        data = io.BufferedReader(gzip.GzipFile(fileobj=data))
    names = FIELDS[1].split()
    first = True
    while line := data.readline():
        if not line.strip(b"\r\n"):
            continue
        if first:  # the version stands in the block, so the opening line is read from its two ends
            values = line.decode().rstrip("\r\n").split(" ")
            header = dict(zip(names[:4], values[:4])) | {"Archive-length": values[-1]}
        else:  # an address may hold blanks: the other fields are counted from the end
            values = line.decode("utf-8", "surrogateescape").rstrip("\r\n").rsplit(" ", len(names) - 1)
            if len(values) != len(names):
                raise ValueError(f"header line with {len(values)} fields where the version has {len(names)}")
            header = dict(zip(names, values))
        length = int(header["Archive-length"])
        block = data.read(length)
        if len(block) < length:
            raise ValueError(f"a record of {header['URL']} ends after {len(block)} of {length} bytes")
        if first:
            version = int(block.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version} is unknown")
            names, first = FIELDS[version].split(), False
            header["version"] = str(version)
        yield header, block


def warc_date(date: str) -> str:
    date = (date + "00000101000000"[len(date):])[:14] if len(date) < 14 else date[:14]
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def header_value(head: bytes, name: str) -> str | None:
    prefix = name.lower().encode() + b":"
    for line in head.split(b"\r\n"):
        if line.lower().startswith(prefix):
            return line[len(prefix):].strip().decode()
    return None


def converted(header: dict[str, str], block: bytes) -> tuple:
    """A row of RECORDS for one ARC record."""
    own = header["URL"], header["IP-address"], warc_date(header["Archive-date"])
    if "version" in header:
        kind, head, payload, number = "warcinfo", b"", block, None
    else:
        split = block.find(b"\r\n\r\n")
        split = len(block) if split < 0 else split + 4
        kind, head, payload = "response", block[:split], block[split:]
        found = header_value(head, ID_HEADER)
        number = int(found) if found else None
    payload_digest = digest(payload)
    identity = "\n".join([kind, *own, str(number), payload_digest]).encode("utf-8", "surrogateescape")
    record_id = str(uuid.UUID(bytes=hashlib.sha256(identity).digest()[:16], version=5))
    return (
        kind, record_id, number, own[0].encode("utf-8", "surrogateescape").decode("utf-8", "replace"), own[1],
        own[2], head, payload, len(payload), payload_digest, digest(block), digest(head),
    )


def arc_records(archives: DataFrame, narrow: bool = False) -> DataFrame:
    """The records of ARC archives with what WARC asks for; `narrow` leaves out heads and payloads."""
    fields = [f for f in RECORDS if not narrow or f[0] in ("kind", "record_id", "number", "payload_bytes", "payload_digest")]
    schema = pa.schema(fields)
    use = [i for i, f in enumerate(RECORDS) if f in fields]
    ddl = ", ".join(RECORDS_DDL.split(", ")[i] for i in use)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column("content"):
                rows = [converted(*record) for record in parse_arc(cell.as_py())]
                columns = list(zip(*rows)) or [()] * len(RECORDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[i], f[1]) for i, f in zip(use, fields)], schema=schema
                )

    return common.in_arrow(archives, parse, ddl)


def convert(archives: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per WARC record: kind, record_id, refers_to, and `record`, its bytes without the last line feed.

    Among records with equal payloads of at least `min_bytes` bytes the one with the smallest number
    (null last) is the response, and so are all that repeat that number with that payload; others
    revisit it. Shorter payloads are all responses.
    """
    number_last = F.struct(F.col("number").isNull().alias("none"), "number", "record_id")
    first = arc_records(archives, narrow=True).filter(
        (F.col("kind") == "response") & (F.col("payload_bytes") >= min_bytes)
    ).groupBy(F.col("payload_digest").alias("_digest")).agg(F.min(number_last).alias("_first"))
    rows = arc_records(archives)
    joined = rows.join(
        first, (rows["payload_digest"] == first["_digest"]) & (rows["kind"] == "response")
        & (rows["payload_bytes"] >= min_bytes), "left",
    )
    again = F.col("_first").isNotNull() & ~F.col("number").eqNullSafe(F.col("_first.number"))
    kind = F.when(again, "revisit").otherwise(F.col("kind"))
    text = lambda s: F.lit(s)
    block = F.when(kind == "revisit", F.col("head")).otherwise(F.concat("head", "payload"))
    lines = [
        F.concat(text("WARC/1.1\r\nWARC-Type: "), kind),
        F.concat(text("WARC-Record-ID: <urn:uuid:"), F.col("record_id"), text(">")),
        F.concat(text("WARC-Date: "), F.col("warc_date")),
        F.when(kind == "warcinfo", F.concat(text("WARC-Filename: "), F.col("url"))).otherwise(
            F.concat(text("WARC-Target-URI: "), F.col("url"))),
        F.when(kind != "warcinfo", F.concat(text("WARC-IP-Address: "), F.col("ip"))),
        F.when(kind != "warcinfo", F.concat(text("WARC-Payload-Digest: sha1:"), F.col("payload_digest"))),
        F.concat(text("WARC-Block-Digest: sha1:"),
                 F.when(kind == "revisit", F.col("head_digest")).otherwise(F.col("block_digest"))),
        F.when(kind == "revisit", F.concat(text(f"WARC-Profile: {REVISIT}\r\nWARC-Refers-To: <urn:uuid:"),
                                           F.col("_first.record_id"), text(">"))),
        F.when(kind == "warcinfo", text("Content-Type: text/plain")).otherwise(
            text("Content-Type: application/http; msgtype=response")),
        F.concat(text("Content-Length: "), F.octet_length(block).cast("string"), text("\r\n\r\n")),
    ]
    return joined.select(
        kind.alias("kind"), "record_id",
        F.when(kind == "revisit", F.col("_first.record_id")).alias("refers_to"),
        F.concat(F.concat_ws("\r\n", *lines).cast("binary"), block, F.lit("\r\n\r").cast("binary")).alias("record"),
    )


def write_warc(records: DataFrame, path: str, records_per_file: int = 2000) -> None:
    """Compressed WARC files; Spark's text writer ends each record with the line feed it still lacks."""
    records.select(F.col("record").cast("string").alias("value")).write.option("compression", "gzip").option(
        "lineSep", "\n"
    ).option("maxRecordsPerFile", records_per_file).text(path)


def parse_warc(data: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record of an archive that is read forward."""
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        header = {}
        while (line := data.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            header[name.strip().lower()] = value.strip()
        length = int(header["content-length"])
        block = data.read(length)
        if len(block) < length:
            raise ValueError(f"a record ends after {len(block)} of {length} bytes")
        yield header, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, url, warc_date, number, payload_bytes, payload_digest, refers_to_id, payload of WARC files.

    Digests of responses are computed anew, and a record that doesn't match its header fails; those of
    revisits, and their payload's length, are what the record says of the full payload.
    """
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("warc_date", pa.string()),
        ("number", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("refers_to_id", pa.string()), ("payload", pa.binary()),
    ])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column("content"):
                rows, size = [], 0
                for header, block in parse_warc(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(cell.as_py())))):
                    if header["warc-type"] not in ("response", "revisit"):
                        continue
                    split = block.find(b"\r\n\r\n")
                    split = len(block) if split < 0 else split + 4
                    head, payload = block[:split], block[split:]
                    own, length = header["warc-payload-digest"].removeprefix("sha1:"), len(payload)
                    if header["warc-type"] == "response" and digest(payload) != own:
                        raise ValueError(f"the payload of {header['warc-record-id']} has another digest")
                    if header["warc-type"] == "revisit":
                        length = int(header_value(head, "Content-Length") or 0)
                    number = header_value(head, ID_HEADER)
                    rows.append((
                        header["warc-record-id"][10:-1], header["warc-type"], header.get("warc-target-uri"),
                        header["warc-date"], int(number) if number else None, length, own,
                        header["warc-refers-to"][10:-1] if "warc-refers-to" in header else None, payload,
                    ))
                    size += len(block)
                    if size > ARCHIVE_BYTES:
                        yield _batch(rows, schema)
                        rows, size = [], 0
                yield _batch(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return common.in_arrow(
        files, parse, "record_id STRING, record_type STRING, url STRING, warc_date STRING, number BIGINT, payload_bytes BIGINT,"
        " payload_digest STRING, refers_to_id STRING, payload BINARY"
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def round_trip(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Pages to ARC to WARC files under `path`, and from there: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload, a null url is written as "-". Rows that repeat a page are written
    each; those that repeat the smallest page_id of a payload are all responses, whatever else
    revisits them. A null page_id loses against any other; a revisit of such a page has a null
    refers_to. An empty table writes no record and gives an empty result. Other columns are ignored.
    """
    write_warc(convert(arc_archives(pages), min_bytes), path)
    records = read_warc(pages.sparkSession, path).drop("payload")
    targets = records.filter("record_type = 'response'").groupBy(F.col("record_id").alias("_target")).agg(
        F.min("number").alias("refers_to")
    )
    return records.join(targets, records["refers_to_id"] == targets["_target"], "left").select(
        F.col("number").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
