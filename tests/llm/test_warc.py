import hashlib
import io
import struct

import pytest
import zstandard

from cohortsieve.llm import warc as W
from cohortsieve.llm.registry import QUERIES
from cohortsieve.session import new_folder

LONG = "<p>" + "long enough to be stored once, é " * 9 + "</p>"


def pages():
    rows = [(i, f"https://h.example.com/{i}", f"<html>page number {i} " + "text " * (i % 40) + "</html>") for i in range(10, 400)]
    return rows + [(1, None, LONG), (2, "http://x/\r\n", LONG), (3, "é", LONG), (4, "u", "tiny"), (5, "u", "tiny"), (6, "u", None), (None, "n", LONG), (7, "big", "x" * 3_000_000)]


def test_round_trip(spark, folder):
    rows = pages()
    got = {r["page_id"]: r for r in QUERIES["op6_warc"](spark, folder(pages=rows)).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        payload, r = (html or "").encode(), got[i]
        first = min(j for j, _, h in rows if h == html and j is not None)
        revisit = len(payload) >= 100 and first != i
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["record_type"], r["refers_to"], r["valid"]) == (("revisit", first) if revisit else ("response", None)) + (True,)


def test_payloads_and_archives(spark, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 20_000)
    df = spark.createDataFrame(pages(), "page_id bigint, url string, html string")
    manifest = W.write_archives(W.with_records(df), new_folder(spark, "warc"))
    assert manifest.count() > 3
    found = {r["page_id"]: r for r in W.read_archives(manifest).collect()}
    assert all(found[i]["payload"] == (h or "").encode() for i, _, h in pages() if found[i]["record_type"] == "response")
    assert found[2]["payload"] is None and found[1]["target_uri"] is None and found[2]["target_uri"] == "http://x/%0D%0A"


def archive(records, dictionary=b""):
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor()
    head = struct.pack("<II", W.DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""
    return head + b"".join(map(packer.compress, records))


def test_dictionary_forms_and_small_reads(monkeypatch):
    monkeypatch.setattr(W, "CHUNK", 7)
    records = [W.record(i, "u", f"payload {i} ".encode() * 20, hashlib.sha256(f"payload {i} ".encode() * 20).hexdigest(), None) for i in range(30)]
    dictionary = W.train(records * 10)
    for data in (archive(records), archive(records, dictionary)):
        assert list(W.decode_frames(io.BytesIO(data))) == records
    packed = zstandard.compress(dictionary)
    squeezed = struct.pack("<II", W.DICTIONARY_MAGIC, len(packed)) + packed + archive(records, dictionary)[8 + len(dictionary):]
    assert list(W.decode_frames(io.BytesIO(squeezed))) == records
    assert list(W.decode_frames(io.BytesIO(b""))) == []
    for broken in (archive(records)[:-3], archive(records) + b"junk!", archive(records)[:5]):
        with pytest.raises(ValueError):
            list(W.decode_frames(io.BytesIO(broken)))


def test_validation():
    good = W.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None)
    assert W.parse(good).error is None and W.parse(good).payload == b"abc"
    assert W.parse(W.record(1, "u", b"abc", "0" * 64, None)).error == "payload digest"
    for bad, why in ((good.replace(b"WARC/1.1", b"WORC/1.1"), "WARC header"), (good[:-1], "Content-Length"), (good + b"x", "Content-Length"),
                     (good.replace(b"abc", b"abd"), "block digest"), (good.replace(b"WARC-Type: response", b"WARC-Type: other"), "record type"),
                     (good.replace(b"WARC-Date: 1970-01-01T00:00:00Z", b"nonsense"), "header line"), (b"", "WARC header")):
        assert why in W.parse(bad).error
    revisit = W.record(2, None, b"abc", "d", 1)
    assert (W.parse(revisit).refers_to, W.parse(revisit).error) == (1, None)
    assert "revisit" in W.parse(revisit.replace(b"WARC-Profile", b"X-Profile")).error


def test_nothing(spark, folder):
    assert QUERIES["op6_warc"](spark, folder(pages=[])).count() == 0
