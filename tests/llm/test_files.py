"""Token-id files and web archives: exact round trips."""

from __future__ import annotations

import base64
import hashlib
import io

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from shopfloor.llm import bitplanes, warc

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_are_reversible(planes, n):
    ids = np.random.default_rng(n).integers(0, [300, 1 << 16, 1 << 32][n % 3], n, dtype=np.uint64).astype("<u4")
    found = bitplanes.to_planes(ids, planes)
    assert len(found) == planes
    assert (bitplanes.from_planes(found, n) == ids).all()


@pytest.mark.parametrize("planes", [4, 32])
def test_any_range_of_a_file_can_be_read(planes):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n).astype("<u4") for n in (3, 0, 250, 1, 64, 0, 129)]
    file = io.BytesIO()
    writer = bitplanes.PlaneWriter(file, 64, planes)
    for ids in docs:
        writer.add(ids)
    writer.close()
    reader = bitplanes.PlaneReader(file, len(file.getvalue()))
    assert [d.tolist() for d in reader.per_document()] == [d.tolist() for d in docs]
    whole = np.concatenate(docs)
    for start, stop in ((0, len(whole)), (5, 5), (63, 65), (64, 128), (200, 201), (100, len(whole))):
        assert (reader.ids(start, stop) == whole[start:stop]).all()


def test_incomplete_files_are_refused():
    file = io.BytesIO()
    writer = bitplanes.PlaneWriter(file, 64, 4)
    writer.add(np.arange(100, dtype="<u4"))
    writer.close()
    with pytest.raises(ValueError, match="not a complete"):
        bitplanes.PlaneReader(io.BytesIO(file.getvalue()[:-3] + b"xyz"), len(file.getvalue()))


def test_ids_of_documents_in_order(documents):
    texts = [(5, "Five words in this one"), (2, None), (9, ""), (3, "Ünï cödé text"), (5, "Another five"), (None, "no id"), (2, None)]
    rows = bitplanes.round_trip(documents(texts), PATH).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(PATH)
    at = 0
    for r in rows:
        assert r["start"] == at and 4 * r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    assert [r["doc_id"] for r in rows] == [None, 2, 2, 3, 5, 5, 9]
    want = sorted((str(i), [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in texts)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows) == want


def test_no_documents_no_files(documents):
    assert bitplanes.round_trip(documents([]), PATH).count() == 0


def test_bundle_frames_are_independent_and_listed():
    file = io.BytesIO()
    writer = warc.BundleWriter(file, 500)
    places = []
    for i in range(20):
        record = warc.warc_record(str(i), None if i % 2 else "http://x/\r\ny", b"p%d " % i * 60, "D", "3" if i == 4 else None)
        places.append((*writer.add(record), len(record)))
    writer.close()
    data = file.getvalue()
    reader = warc.BundleReader(io.BytesIO(data), len(data))
    for i in (19, 0, 7, 4):
        headers, block = reader.record(*places[i])
        assert headers["X-Record-Key"] == str(i)
        assert block == (b"" if i == 4 else b"p%d " % i * 60)
    # Any reader of the compression format sees one stream; the table is skipped.
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 20


def test_pages_round_trip(spark):
    pages = [
        (4, "http://a", "<p>same</p>"), (2, None, "<p>same</p>"), (9, "http://c", None), (1, "", ""), (7, "http://é\nx", "WARC/1.1\r\n\r\n"),
        (7, "http://d", "other"), (2, "http://e", "<p>same</p>"), (None, "http://f", "<p>same</p>"), (None, "http://g", "nobody else"),
    ]
    table = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, digest string, size int")
    rows = warc.round_trip(table).collect()
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in rows), key=str)
    want = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        ids = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        first = min(ids, default=None)
        repeats = first is not None and page_id != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page_id, "revisit" if repeats else "response", first if repeats else None, len(data), digest))
    assert got == sorted(want, key=str)
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in rows)


def test_short_payloads_are_never_revisits(spark):
    table = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    rows = {r["page_id"]: r["record_type"] for r in warc.round_trip(table, 3).collect()}
    assert rows == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.round_trip(table.limit(0)).count() == 0
