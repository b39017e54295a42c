import base64
import gzip
import hashlib
import io

import pytest

from tillwright.llm import warc

PAGES = "page_id BIGINT, url STRING, html STRING"
ROWS = [
    (4, "http://a/1", "same"), (2, "http://a/2", "same"), (9, "http://a b/3", "same"), (2, "http://a/2", "same"),
    (5, None, None), (6, "http://x\n/y", ""), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 3), (None, "n", "same"),
    (None, "n", "alone"), (8, "é", "ü" * 400_000), (10, "h", "filedesc://x 0.0.0.0 1 text/plain 3\n"), (11, "b", "short"),
]


def plain(rows, min_bytes=0):
    out, first = [], {}
    for number, _, html in rows:
        data = (html or "").encode()
        if number is not None:
            first[data] = min(number, first.get(data, number))
    for number, _, html in rows:
        data = (html or "").encode()
        own = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = len(data) >= min_bytes and first.get(data, number) != number
        out.append((number, len(data), own, "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, tmp_path, min_bytes):
    df = spark.createDataFrame(ROWS, PAGES)
    assert rows_of(warc.round_trip(df, str(tmp_path / "w"), min_bytes)) == plain(ROWS, min_bytes)


def test_clashing_columns(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, PAGES).select(
        "*", F.lit(1).alias("HTML"), F.lit(2).alias("record_id"), F.lit(3).alias("content"), F.lit(4).alias("_first")
    )
    assert rows_of(warc.round_trip(df, str(tmp_path / "w"))) == plain(ROWS)


def test_empty_table(spark, tmp_path):
    assert warc.round_trip(spark.createDataFrame([], PAGES), str(tmp_path / "w")).collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    opening = warc.arc_opening("x.arc", version, "19990102030405")
    blocks = [b"HTTP/1.0 200 OK\r\n\r\nbody", b"", b"\n\nno head"]
    data = opening + b"".join(warc.arc_record("x.arc", version, 9, "http://a b/c", "19990102", b) for b in blocks)
    for content in (data, gzip.compress(opening) + gzip.compress(data[len(opening):])):
        found = list(warc.parse_arc(content))
        assert [b for _, b in found[1:]] == blocks
        assert found[0][0]["version"] == str(version)
        assert found[1][0]["URL"] == "http://a b/c" and len(found[1][0]) == (5 if version == 1 else 10)


def test_broken_archives_fail():
    opening = warc.arc_opening("x.arc", 1, "19990102030405")
    with pytest.raises(ValueError):
        list(warc.parse_arc(opening + b"\nhttp://a 1.2.3.4 1999 text/html 50\nshort"))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"filedesc://x 0.0.0.0 1 text/plain 12\n7 0 archive\n"))


def test_records_as_written(spark, tmp_path):
    df = spark.createDataFrame(ROWS, PAGES)
    warc.write_warc(warc.convert(warc.arc_archives(df)), str(tmp_path / "w"), records_per_file=3)
    files = sorted((tmp_path / "w").glob("*.gz"))
    assert len(files) > 2
    found = [r for f in files for r in warc.parse_warc(io.BytesIO(gzip.decompress(f.read_bytes())))]
    kinds = [h["warc-type"] for h, _ in found]
    assert kinds.count("warcinfo") >= 1 and len(kinds) - kinds.count("warcinfo") == len(ROWS)
    ids = {h["warc-record-id"] for h, _ in found if h["warc-type"] == "response"}
    for header, block in found:
        assert header["warc-block-digest"] == "sha1:" + warc.digest(block)
        assert header["warc-date"] == "1999-01-01T00:00:00Z"
        if header["warc-type"] == "revisit":
            assert header["warc-refers-to"] in ids and block.endswith(b"\r\n\r\n")


def test_short_dates():
    assert warc.warc_date("1999") == "1999-01-01T00:00:00Z"
    assert warc.warc_date("19990203040506") == "1999-02-03T04:05:06Z"
