"""Archives: exact round trips, member by member."""

import gzip
import hashlib
import zlib

import pytest
from pyarrow import fs

from fareflow.llm import warc
from fareflow.session import scratch_path


def fixture():
    big, other = "<p>" + "x é🙂" * 60, "y" * 100
    rows = [(5, "http://a/", big), (3, "http://b/", big), (9, None, big), (4, "http://c/\r\nX: y", other), (1, "", "y" * 99),
            (2, "u", "y" * 99), (6, "u", None), (7, "u", ""), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 9), (3, "http://b/", big),
            (None, "u", other), (10, "u", "z" * 3_000_000), (11, "u", "WARC/1.1\nContent-Length: 5\n" * 10)]
    return rows


def want(rows):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        revisit = len(data) >= 100 and same and min(same) != key
        out.append((key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                    min(same) if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    pages = spark.createDataFrame(fixture(), "page_id long, url string, html string").repartition(3)
    assert sorted(map(tuple, warc.round_trip(pages).collect()), key=repr) == want(fixture())
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_members_stand_alone_and_add_up(spark):
    pages = spark.createDataFrame(fixture(), "page_id long, url string, html string")
    raw, out = (warc.qualified(spark, scratch_path(spark, n)) for n in ("raw", "out"))
    warc.write_monolithic(pages, raw)
    index = warc.normalise(spark, raw, out).collect()
    old = b"".join(gzip.decompress(_bytes(p)) for p in _files(raw, ".gz"))
    new = b""
    for path in _files(out, ".gz"):
        data, at = _bytes(path), 0
        for row in sorted((r for r in index if r.archive.endswith(path.rpartition("/")[2])), key=lambda r: r.at):
            assert row.at == at
            new += zlib.decompress(data[at:at + row.length], 31)
            at += row.length
        assert at == len(data)
    assert len(old) == len(new) and sorted(warc.records(iter([old]))) == sorted(warc.records(iter([new])))
    header = next(h for h, _ in warc.records(iter([new])) if b"urn:x-page:4>" in h)
    assert warc.header_fields(header)["warc-target-uri"] == "http://c/%20%20X:%20y"


def _files(root, end):
    system, path = warc._opened(root)
    return sorted(f.path for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.path.endswith(end))


def _bytes(path):
    with open(path, "rb") as file:
        return file.read()


def test_broken_archives_are_errors():
    header = b"WARC/1.1\r\nContent-Length: 9\r\n\r\n"
    assert list(warc.records(iter([header, b"123", b"456789\r\n\r", b"\n"]))) == [(header, b"123456789")]
    for cut in (header[:20], header + b"123"):
        with pytest.raises(ValueError):
            list(warc.records(iter([cut])))
    with pytest.raises(ValueError):
        record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: x\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 5\r\n\r\na\r\n\r\nb"
        warc.read_member(gzip.compress(record))
