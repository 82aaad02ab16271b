import base64
import gzip
import hashlib
from collections import defaultdict

import pytest

from tiermill.llm.queries import op4_warc
from tiermill.llm.warc import (
    arc_records,
    convert_arc,
    read_warc,
    warc_records,
    with_referred_page,
    write_arc,
    write_warc,
)

SF_DIR = "/root/testdata/sf0.001"


def expected(pages, least=0):
    groups, out = defaultdict(list), []
    for page_id, html in pages:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        groups[digest].append(page_id)
        out.append((page_id, len(payload), digest))
    low = {d: min(ids, key=lambda i: (i is None, i)) for d, ids in groups.items()}
    for page_id, size, digest in out:
        first = low[digest]
        if size >= least and page_id != first:
            yield page_id, size, digest, "revisit", first
        else:
            yield page_id, size, digest, "response", None


def test_query(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html").collect()
    found = sorted(map(tuple, op4_warc(spark, SF_DIR).collect()))
    assert found == sorted(expected([tuple(p) for p in pages]))


EDGE = [
    (1, "http://a/ b\n", "<p>ü\r\n\r\nWARC/1.1\r\n\r\n</p>\n"),
    (2, "http://b/", None),
    (3, None, ""),
    (4, "", "x" * 300_000 + "\n\n"),
    (5, "http://c/", "x" * 300_000 + "\n\n"),
    (6, "http://c/", "same"),
    (None, "http://c/", "same"),
    (7, "http://d/ \x00", "﻿text\x00"),
]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("least", [0, 100])
def test_edge_rows(spark, tmp_path, version, least):
    schema = "page_id long, url string, html string, record string, block string"
    rows = [(i, u, h, "x", "y") for i, u, h in EDGE]
    pages = spark.createDataFrame(rows, schema)
    write_arc(pages.select("page_id", "url", "html"), str(tmp_path / "arc"), version)
    write_warc(convert_arc(spark, str(tmp_path / "arc")), str(tmp_path / "warc"), least)
    records = read_warc(spark, str(tmp_path / "warc"))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    found = with_referred_page(records).select(*columns).collect()
    want = expected([(i, h) for i, _, h in EDGE], least)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    texts = {r["page_id"]: r["payload"] for r in records.filter("record_type = 'response'").collect()}
    assert texts[1] == EDGE[0][2] and texts[7] == EDGE[7][2]
    again = convert_arc(spark, str(tmp_path / "arc")).select("record_id").collect()
    first = convert_arc(spark, str(tmp_path / "arc")).select("record_id").collect()
    assert sorted(again) == sorted(first) and len(set(first)) == len(EDGE)


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    write_arc(none, str(tmp_path / "arc"))
    write_warc(convert_arc(spark, str(tmp_path / "arc")), str(tmp_path / "warc"))
    assert read_warc(spark, str(tmp_path / "warc")).count() == 0


def test_files_are_archives(spark, tmp_path):
    pages = spark.createDataFrame(EDGE, "page_id long, url string, html string")
    write_arc(pages.coalesce(1), str(tmp_path / "arc"), 2)
    content = next((tmp_path / "arc").glob("*.gz")).read_bytes()
    assert gzip.decompress(content).startswith(b"filedesc://") and len(list(arc_records(content))) == len(EDGE)
    write_warc(convert_arc(spark, str(tmp_path / "arc")), str(tmp_path / "warc"))
    for path in (tmp_path / "warc").glob("*.gz"):
        for fields, block in warc_records(path.read_bytes()):
            assert fields["warc-type"] in ("response", "revisit")
            assert int(fields["content-length"]) == len(block)
            assert fields["warc-date"].endswith("Z") and "<" not in fields["warc-record-id"][1:]


def test_version_1_address_with_blanks():
    head = b"filedesc://x 0.0.0.0 20000101000000 text/plain 78\n1 0 archiver\n"
    names = b"URL IP-address Archive-date Content-type Archive-length\n"
    head = head.replace(b"78", str(len(b"1 0 archiver\n" + names)).encode()) + names
    record = b"http://a b/c 1.2.3.4 20010203040506 text/html 5\nab\ncd\n"
    (found,) = arc_records(gzip.compress(head + b"\n") + gzip.compress(record))
    assert found["URL"] == "http://a b/c" and found["block"] == b"ab\ncd"


def test_short_file_is_an_error():
    head = b"filedesc://x 0.0.0.0 20000101000000 text/plain 900\n1 0 archiver\n"
    with pytest.raises(ValueError):
        list(arc_records(gzip.compress(head)))


def arc(*records, padding=0):
    names = b"URL IP-address Archive-date Content-type Archive-length\n"
    text = b"1 0 archiver\n" + names
    out = gzip.compress(b"filedesc://x 0.0.0.0 20000101000000 text/plain %d\n%s" % (len(text), text))
    for url, mime, block in records:
        line = b"%s 1.2.3.4 20010203040506 %s %d\n" % (url, mime, len(block))
        out += gzip.compress(line + block + b"\n")
    return out + bytes(padding)


def test_bytes_other_protocols_and_padding(spark, tmp_path):
    """Latin-1 pages, images and name look-ups come through as they are, in a file with a gzip member for
    each record and zeros after the last."""
    image = bytes(range(256)) * 5
    head = b"HTTP/1.1 200 OK\r\nX-Page-Id: %d\r\nContent-Length: %d\r\nX-Name: caf\xe9\r\n\r\n"
    latin = "caf\xe9 \r\n\r\n".encode("latin-1")
    records = [
        (b"http://a/", b"text/html", head % (1, len(latin)) + latin),
        (b"http://b/", b"image/png", head % (2, len(image)) + image),
        (b"http://c/", b"image/png", head % (3, len(image)) + image),
        (b"dns:a", b"text/dns", b"20010203040506\na. 60 IN A 1.2.3.4\n"),
        (b"dns:a", b"text/dns", b"20010203040506\na. 60 IN A 1.2.3.4\n"),
    ]
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "x.arc.gz").write_bytes(arc(*records, padding=5000))
    folder = str(tmp_path / "warc")
    write_warc(convert_arc(spark, str(tmp_path / "arc")), folder)
    found = read_warc(spark, folder, binary=True)
    rows = {(r["uri"], r["page_id"]): r for r in with_referred_page(found).collect() if r["page_id"]}
    assert bytes(rows["http://a/", 1]["payload"]) == latin
    assert bytes(rows["http://b/", 2]["payload"]) == image
    revisit = rows["http://c/", 3]
    assert (revisit["record_type"], revisit["refers_to"], revisit["payload"]) == ("revisit", 2, None)
    names = found.filter("uri = 'dns:a'").collect()
    assert [r["record_type"] for r in names] == ["resource"] * 2
    assert all(bytes(r["payload"]) == records[3][2] for r in names)
    assert {r["payload_digest"] for r in names} == {
        base64.b32encode(hashlib.sha1(records[3][2]).digest()).decode()
    }
    blocks = [b for p in (tmp_path / "warc").glob("*.gz") for _, b in warc_records(p.read_bytes())]
    assert sorted(blocks) == sorted(
        [records[0][2], records[1][2], records[2][2].partition(b"\r\n\r\n")[0] + b"\r\n\r\n", records[3][2], records[4][2]]
    )
    assert read_warc(spark, folder).filter("page_id = 1").first()["payload"] == "caf\ufffd \r\n\r\n"


def test_who_is_first_does_not_depend_on_the_size_of_the_list(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tiermill.llm.common.BROADCAST_ROWS", 0)
    pages = spark.createDataFrame(EDGE, "page_id long, url string, html string")
    write_arc(pages, str(tmp_path / "arc"))
    heads = convert_arc(spark, str(tmp_path / "arc"), payloads=False)
    assert heads.filter("payload IS NOT NULL").count() == 0
    write_warc(convert_arc(spark, str(tmp_path / "arc")), str(tmp_path / "warc"), 0, heads)
    records = with_referred_page(read_warc(spark, str(tmp_path / "warc")))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    found = map(tuple, records.select(*columns).collect())
    assert sorted(map(str, found)) == sorted(map(str, expected([(i, h) for i, _, h in EDGE])))
