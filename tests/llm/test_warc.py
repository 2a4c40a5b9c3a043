"""Archives: an exact round trip, records by contract, and what damage is named."""

import base64
import hashlib
import struct

import pytest
import zstandard

from areaflow.llm import warc


def archive(*records, words=b"", packed=True):
    lead = zstandard.ZstdCompressor().compress(words) if packed else words
    press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    return struct.pack("<II", warc.DICTIONARY_FRAME, len(lead) if words else 0) + (lead if words else b"") + b"".join(map(press.compress, records))


PAGE = warc.record(5, "http://x/ y", b"<p>one", 5, False)


@pytest.mark.parametrize("packed", [True, False])
def test_frames_with_and_without_a_dictionary(packed):
    again = warc.record(6, None, b"<p>one", 5, True)
    for words in (b"", b"<p>one two three WARC/1.1 Content-Length: " * 20):
        data = memoryview(archive(PAGE, again, PAGE * 5000, words=words, packed=packed))
        assert list(warc.frames(data)) == [PAGE, again, PAGE * 5000]
    assert list(warc.frames(memoryview(b""))) == []


def test_fields_of_records():
    sha = base64.b32encode(hashlib.sha1(b"<p>one").digest()).decode()
    got = warc.parsed(PAGE)
    assert (got["error"], got["payload"], got["payload_length"], got["payload_digest"]) == (None, b"<p>one", 6, sha)
    assert got["uri"] == "http://x/%20y" and got["record_id"] == "urn:page:5" and got["refers_to"] is None
    got = warc.parsed(warc.record(6, None, b"<p>one", 5, True))
    assert (got["error"], got["type"], got["payload"], got["payload_length"], got["payload_digest"], got["refers_to"]) == (None, "revisit", None, 6, sha, "urn:page:5")


@pytest.mark.parametrize(
    ("damage", "said"),
    [
        (lambda d: d[:-3], "bytes, not"), (lambda d: d + b"x", "bytes, not"), (lambda d: d.replace(b"one", b"two"), "another digest"),
        (lambda d: d.replace(b"WARC/1.1", b"HTTP/1.1"), "version"), (lambda d: d.replace(b"WARC-Date", b"Date"), "missing warc-date"),
        (lambda d: d.replace(b"WARC-Type: ", b"WARC-Type "), "no field"), (lambda d: b"", "version"),
    ],
)
def test_damage_is_named(damage, said):
    assert said in warc.parsed(damage(PAGE))["error"]


def test_cut_off_frames():
    data = archive(PAGE, PAGE)
    for n in (3, 10, len(data) - 5):
        with pytest.raises((ValueError, zstandard.ZstdError, struct.error)):
            list(warc.frames(memoryview(data[: len(data) - n])) if n > 5 else warc.frames(memoryview(archive(PAGE, words=b"abc" * 9)[:12])))


def test_round_trip_of_a_table(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, f"http://h/{i}" if i % 3 else None, f"<p>page {i // 2} é" * (i % 50)) for i in range(300)]
    rows += [(900, None, None), (901, "u\r\nX: y", None), (None, "n", "<p>alone"), (None, "n", rows[10][2]), (902, "long", "x" * 100_000), (902, "long", "x" * 100_000)]
    pages = frame("page_id long, url string, html string, sha string", *[(*r, "own") for r in rows])
    folder = f"file://{tmp_path}/warc"
    written = warc.write_archives(pages.repartition(3), folder).collect()
    assert sum(r["records"] for r in written) == len(rows) and len(written) > 3
    got = warc.read_archives(spark, folder).collect()
    assert len(got) == len(rows) and not [r for r in got if r["error"]]
    first, expected = {}, []
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        lead = first.setdefault(data, i)
        again = lead is not None and i != lead
        expected.append((warc.name_of(i), "revisit" if again else "response", None if again else data, len(data), warc.name_of(lead) if again else None))
    assert sorted(((r["record_id"], r["type"], r["payload"], r["payload_length"], r["refers_to"]) for r in got), key=str) == sorted(expected, key=str)
    (tmp_path / "warc" / "bad.warc.zst").write_bytes(archive(PAGE)[:-4])
    assert [r["error"] for r in warc.read_archives(spark, folder).collect() if r["error"]]


def test_empty_table(spark, frame, tmp_path):
    pages = frame("page_id long, url string, html string", (1, "u", "h")).limit(0)
    assert warc.write_archives(pages, f"file://{tmp_path}/none").count() == 0
