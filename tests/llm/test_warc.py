import base64
import hashlib
import zlib

import pytest

from tidemark.llm import warc as W
from tidemark.llm.shared import new_path


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows):
    most = {}
    for page, _, text in rows:
        if page is not None:
            most[digest(text)] = max(most.get(digest(text), page), page)
    out = []
    for page, _, text in rows:
        m = most.get(digest(text))
        revisit = m is not None and page != m
        out.append((page, len((text or "").encode()), digest(text), "revisit" if revisit else "response", m if revisit else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/b c", "<p>é😀</p>"), (2, None, None), (3, "http://x/\n\r", ""), (4, "http://y/%20", "same"), (9, "http://z", "same"), (7, "é", "same"), (-5, "u", "neg"), (5, "u", "WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"),
        (6, "u", "1 0 x\nURL IP-address Archive-date Content-type Archive-length\nhttp://a 0.0.0.0 20200101000000 text/html 5\nabc"), (None, "n", "same"), (None, "n", "alone"), (8, "u", "\r\nX-Page-Id: 99\r\n\r\n"), (4, "http://y/%20", "same"), (10, "u", "x" * 3_000_000)]
NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("most,broadcast", [(W.ARCHIVE_BYTES, W.MOST_BROADCAST), (50, 0)])
def test_round_trip(spark, most, broadcast):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, payload string")
    got = W.convert_pages(df, most, broadcast)
    assert sorted(map(tuple, got.select(*NAMES).collect()), key=repr) == brute(ROWS)
    assert len({r.record_id for r in got.collect() if r.page_id not in (None, 4)}) == len([r for r in ROWS if r[0] not in (None, 4)])
    assert W.convert_pages(df.limit(0)).count() == 0


def test_pages_whole(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, W.op6_warc_conversion(spark, sf).select(*NAMES).collect()), key=repr) == brute(rows)


def test_files_are_archives(spark, tmp_path):
    """Every file is a run of gzip members; versions take turns; revisits carry no payload."""
    df = spark.createDataFrame(ROWS[:9], "page_id long, url string, html string").coalesce(1)
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    W.pages_to_arc(df, arc, most=60)
    W.arc_to_warc(spark, arc, warc, 200)
    files = [bytes(r.content) for r in W.archives(spark, arc).collect()]
    assert {W.ARC_FIELDS[v].decode() in zlib.decompress(f, 31).decode() for f in files for v in (1,)} == {True, False}
    for data in (bytes(r.content) for r in W.archives(spark, warc).collect()):
        assert data[-1] == 0 and b"".join(W.members(data)).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        for h, block in W.parse_warc(data):
            if h["warc-type"] == "revisit":
                assert block.endswith(b"\r\n\r\n") and h["warc-profile"].endswith("identical-payload-digest") and h["warc-refers-to"].startswith("<urn:uuid:")
    ids = {r.record_id: r.page_id for r in W.read_warc(spark, warc).collect()}
    for data in (bytes(r.content) for r in W.archives(spark, warc).collect()):
        for h, _ in W.parse_warc(data):
            if "x-refers-to-page" in h:
                assert ids[h["warc-refers-to"]] == int(h["x-refers-to-page"])


def test_broken_archives():
    good = W.version_block(1, "n", "20200101000000") + W.arc_record(1, "u", "20200101000000", b"body", 0, "n")
    assert [b for _, b in W.parse_arc(W.member(good))] == [b"body"]
    for data in (good[:-4], good.replace(b"1 0 tidemark", b"3 0 tidemark"), good[len(W.version_block(1, "n", "20200101000000")) :], good.replace(b"text/html", b"text/html extra")):
        with pytest.raises(ValueError):
            list(W.parse_arc(W.member(data)))
    with pytest.raises(ValueError):
        list(W.members(W.member(good)[:-9]))
    with pytest.raises(ValueError):
        list(W.parse_warc(W.member(b"nothing\r\n\r\n")))


def test_least_bytes(spark):
    df = spark.createDataFrame([(1, "d", 3), (2, "d", 3), (3, "e", 9), (4, "e", 9)], "page_id long, payload_digest string, n int")
    assert [tuple(r) for r in W.revisits(df, 5, "n").collect()] == [(3, "e", 4)]
