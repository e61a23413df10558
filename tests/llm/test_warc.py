"""Web archives against gzip and plain parsing."""

import base64
import gzip
import hashlib
import io
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sonomere.llm import warc
from sonomere.llm.queries import archived_pages

SCHEMA = "page_id bigint, url string, html string, key string, payload string, refers_to int, archive string"
LONG = "<p>é" * 300_000
PAGES = [
    (5, "http://a/", "<html>one</html>"), (3, "http://b/", "<html>one</html>"), (9, None, "<html>one</html>"),
    (1, "http://c/\r\nX: y", None), (2, "http://d/ü ", ""), (4, "u", "two\r\n\r\nWARC/1.1\r\n"), (6, "u", LONG),
    (7, "u", LONG), (None, "u", "<html>one</html>"), (None, "u", "no id"), (8, "u", "twice"), (8, "u", "twice"),
    (10, "", "\x00\r\n\r\n"), (11, "u", "twice"),
]
KEY = lambda r: tuple((x is not None, x) for x in r)


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "p", 1, "a") for r in rows], SCHEMA)


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain_rows(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        least = min((k for k, _, h in rows if (h or "") == (html or "") and k is not None), default=None)
        first = least is None or i == least
        kind = "response" if first else "revisit"
        out.append((i, len(data), digest(data), kind, None if first else least))
    return out


def test_pages(spark, tmp_path):
    found = archived_pages(table(spark, PAGES), str(tmp_path))
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.collect()), key=KEY) == sorted(plain_rows(PAGES), key=KEY)
    assert archived_pages(table(spark, []), str(tmp_path / "none")).count() == 0


def test_hot_payloads(spark, tmp_path, monkeypatch):
    """Groups that are broadcast and groups that are joined give the same."""
    monkeypatch.setattr(warc, "HOT_GROUPS", 2)
    rng = random.Random(2)
    rows = [(i, "u", rng.choice(["a", "a", "a", "b", "b", "c", "d", f"own {i}"])) for i in range(400)]
    rng.shuffle(rows)
    found = archived_pages(table(spark, rows), str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=KEY) == sorted(plain_rows(rows), key=KEY)


def test_small_payloads_can_be_left_alone(spark):
    pages = table(spark, PAGES).withColumn("payload", F.encode("html", "UTF-8"))
    found = warc.with_first_of_equals(pages, least_bytes=10).collect()
    assert {r.page_id for r in found if r.refers_to is not None} == {5, 9, None, 7}


def written(spark, tmp_path, size):
    pages = table(spark, PAGES).select("page_id", "url", F.encode("html", "UTF-8").alias("payload"))
    marked = warc.with_first_of_equals(pages).repartition(2)
    return warc.write_archives(marked, str(tmp_path), archive_bytes=size)


def test_files_are_plain_warc(spark, tmp_path):
    """Every record a gzip member of its own, told apart by content lengths alone."""
    listed = written(spark, tmp_path, 1).collect()
    assert len(listed) == len(PAGES) and all(r.records == 1 for r in listed)
    seen = {}
    for r in listed:
        path = Path(r.archive)
        assert path.stat().st_size == r.bytes
        data = gzip.decompress(path.read_bytes())
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            first, *lines = head.decode().split("\r\n")
            assert first == "WARC/1.1"
            fields = dict(line.split(": ", 1) for line in lines)
            size = int(fields["Content-Length"])
            block, data = data[:size], data[size:]
            assert data[:4] == b"\r\n\r\n"
            data = data[4:]
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Block-Digest"] == "sha1:" + digest(block)
                payload = block.partition(b"\r\n\r\n")[2]
                assert fields["WARC-Payload-Digest"] == "sha1:" + digest(payload)
                seen[fields["WARC-Record-ID"]] = payload
    assert seen["<urn:page:6>"] == LONG.encode()
    assert seen["<urn:page:1>"] == b""


def test_payloads_come_back(spark, tmp_path):
    found = warc.read_archives(written(spark, tmp_path, 1 << 20), payloads=True)
    data = {r.record_id: r for r in found.collect()}
    assert bytes(data["urn:page:6"].payload) == LONG.encode() and data["urn:page:7"].payload is None
    assert data["urn:page:1"].target_uri == "http://c/%0D%0AX:%20y"
    assert data["urn:page:9"].target_uri is None
    assert warc.broken_revisits(found).count() == 0
    lost = found.filter("record_id <> 'urn:page:6'")
    assert [tuple(r)[0] for r in warc.broken_revisits(lost).collect()] == ["urn:page:6"]


def test_unlisted_files_are_not_read(spark, tmp_path):
    listed = written(spark, tmp_path, 1 << 20)
    (tmp_path / "part-00000-lost-00000.warc.gz").write_bytes(b"half a member")
    assert warc.read_archives(listed).count() == len(PAGES)


def archive(*pages):
    return b"".join(b"".join(warc.member(warc.record_bytes(p, "2020-01-01T00:00:00Z"))) for p in pages)


class Slow(io.BytesIO):
    """A source that gives a few bytes at a time."""

    def read(self, size=-1):
        return super().read(min(size, 7))


def test_any_piece_size():
    pages = [warc.Page(f"urn:page:{i}", "u", bytes([65 + i]) * i * 1000) for i in range(20)]
    found = list(warc.read_records(Slow(archive(*pages)), "a", keep_payload=True))
    assert [b"".join(r.payload) for r in found] == [p.payload for p in pages]
    assert found[0].offset == 0 and found[1].offset == len(archive(pages[0]))


def test_memory_is_a_piece():
    """A record that is not kept is never held."""
    members = warc._Members(io.BytesIO(archive(warc.Page("r", "u", b"x" * (20 << 20)))), "a")
    members.begin()
    members.until(b"\r\n\r\n")
    members.until(b"\r\n\r\n")
    largest = max(len(members.buffer) + len(x) for x in members.take(20 << 20))
    assert largest <= 2 * warc.PIECE


def damaged():
    good = warc.record_bytes(warc.Page("r", "u", b"payload"), "2020-01-01T00:00:00Z")
    pack = lambda x: b"".join(warc.member(x))
    yield "Truncated", pack(good)[:-9]
    yield "Broken gzip", b"no gzip at all"
    yield "Broken gzip", pack(good)[:40] + b"\x00\x01\x02" + pack(good)[43:]
    yield "Wrong warc-block-digest", pack(good.replace(b"HTTP/1.1", b"HTTP/1.0"))
    yield "Wrong warc-payload-digest", pack(good.replace(b"payload\r", b"pay1oad\r"))
    yield "Content longer", pack(good + b"more")
    yield "Content shorter", pack(good[:-8])
    yield "without a version", pack(good.replace(b"WARC/1.1", b"WORC/1.1"))
    yield "without a content length", pack(good.replace(b"Content-Length", b"Content-Size"))
    yield "Header without an end", pack(b"WARC/1.1\r\n" + b"a" * 10)


@pytest.mark.parametrize("why, data", list(damaged()))
def test_damage(why, data):
    whole = archive(warc.Page("first", "u", b"fine"))
    with pytest.raises(warc.BadArchive, match=why) as error:
        list(warc.read_records(io.BytesIO(whole + data), "name"))
    assert "name" in str(error.value) and f"byte {len(whole)}" in str(error.value)
