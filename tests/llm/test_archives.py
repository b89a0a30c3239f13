"""Files that are written and read back: operators 4 and 8."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from rowmill.llm import seekable, token_files, warc
from rowmill.llm.common import tokenizer_path
from llm_helpers import AWKWARD, LONG, collected, documents

BYTE_BPE = tokenizer_path("byte_bpe_50k.json")

PAGES = [
    (1, "http://a/?q=1%202\r\nX", "<p>one</p>"), (2, None, "<p>two</p>"), (3, "u é", "<p>one</p>"),
    (4, "u", None), (5, "u", ""), (6, "u", LONG), (7, "u", "a\r\n\r\nb"), (8, "u", "<p>one</p>"),
    (3, "u é", "<p>one</p>"), (None, "u", "<p>two</p>"), (None, "u", "only"), (None, "u", "only"),
]


def pages(spark):
    kinds = "page_id long, url string, html string, record_type string, sha string"
    return spark.createDataFrame([(*p, "x", "y") for p in PAGES], kinds)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_frames_survive_and_damage_is_found(tmp_path):
    path = str(tmp_path / "x.zst")
    writer = seekable.SeekableWriter("file://" + path, frame_bytes=100)
    places = [writer.add(bytes([i]) * (i * 7)) for i in range(40)]
    writer.close(pa.table({"i": list(range(40))}))
    with seekable.SeekableReader("file://" + path) as reader:
        assert reader.index().column("i").to_pylist() == list(range(40))
        for i, (frame, offset) in enumerate(places):
            if i:
                assert reader.frame(frame)[offset : offset + i * 7] == bytes([i]) * (i * 7)
    data = open(path, "rb").read()
    whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(data)
    assert whole == b"".join(bytes([i]) * (i * 7) for i in range(40))
    table = reader.table
    checked = bytearray(data)
    at = data.index(np.array([table[0][2]], "<u4").tobytes(), len(data) - 13 * (len(table) + 2))
    checked[at] ^= 1
    open(path, "wb").write(checked)
    with seekable.SeekableReader("file://" + path) as reader, pytest.raises(ValueError, match="damaged"):
        reader.frame(0)


def test_records_come_back(spark, tmp_path):
    manifest = warc.write_warc(pages(spark), str(tmp_path), file_bytes=1000)
    got = collected(warc.read_warc(manifest))
    assert len(got) == len(PAGES)
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = Counter()
    for i, url, html in PAGES:
        known = first.get(html or "")
        revisit = known is not None and i != known
        payload = None if revisit else (html or "").encode()
        want[i, url, "revisit" if revisit else "response", known if revisit else None,
             len((html or "").encode()), digest(html), payload] += 1
    assert Counter(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r.values()) for r in got) == want


def test_small_payloads_are_all_responses(spark, tmp_path):
    got = collected(warc.archive(pages(spark), str(tmp_path), min_bytes=11))
    assert {r["record_type"] for r in got} == {"response"} and {r["refers_to"] for r in got} == {None}


def test_wanted_records_only(spark, tmp_path):
    manifest = warc.write_warc(pages(spark), str(tmp_path))
    wanted = spark.createDataFrame([(6,), (3,), (99,)], "page_id long")
    got = collected(warc.read_warc(manifest, wanted))
    assert sorted(r["page_id"] for r in got) == [3, 3, 6]
    assert next(bytes(r["payload"]) for r in got if r["page_id"] == 6) == LONG.encode()


def test_no_pages(spark, tmp_path):
    assert collected(warc.archive(pages(spark).where("false"), str(tmp_path))) == []


def test_a_damaged_record_is_refused():
    data = warc.record_bytes(1, "u", b"abc", digest("abd"), None, False, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(data)


def want_tokens(rows):
    """(doc_id, start, ids) in ascending order of the ids, nulls first."""
    lib, out, start = Tokenizer.from_file(BYTE_BPE), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


UNIQUE = [r for r in AWKWARD if r[0] is not None and r != (1, "the quick brown fox")] + [(1, "the quick"), (None, "x y")]


@pytest.mark.parametrize("file_ids", [20, token_files.FILE_IDS])
def test_token_files_come_back(spark, tmp_path, file_ids):
    docs = documents(spark, UNIQUE, ["ids", "start"]).repartition(5)
    manifest = token_files.write_token_files(docs, BYTE_BPE, 2, str(tmp_path), file_ids=file_ids)
    got = collected(token_files.read_token_files(manifest))
    assert sorted(((*list(r.values())[:3], bytes(r["ids"])) for r in got), key=lambda r: r[1]) == want_tokens(UNIQUE)
    wanted = spark.createDataFrame([(5,), (6,), (99,)], "doc_id long")
    some = collected(token_files.read_token_files(manifest, wanted))
    assert sorted(((*list(r.values())[:3], bytes(r["ids"])) for r in some), key=lambda r: r[1]) == [
        r for r in want_tokens(UNIQUE) if r[0] in (5, 6)
    ]


def test_repeated_rows_follow_each_other(spark, tmp_path):
    manifest = token_files.write_token_files(documents(spark, AWKWARD), BYTE_BPE, 2, str(tmp_path))
    got = sorted(collected(token_files.read_token_files(manifest)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in AWKWARD), key=lambda i: (i is not None, i or 0))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
    assert zlib.crc32(bytes(got[0]["ids"])) == zlib.crc32(np.array([2], "<u4").tobytes()) or got[0]["n_tokens"] > 1


def test_no_documents(spark, tmp_path):
    manifest = token_files.write_token_files(documents(spark, []), BYTE_BPE, 2, str(tmp_path))
    assert collected(token_files.read_token_files(manifest)) == []
