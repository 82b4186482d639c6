"""Archives written and read back, whole and damaged."""

import base64
import gzip
import hashlib
import random
from collections import defaultdict

import pytest
from conftest import SF

from lexweave.llm import warc
from lexweave.llm.catalogue import QUERIES


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(pages):
    first = defaultdict(list)
    for page, html in pages:
        first[html or ""].append(page)
    rows = []
    for page, html in pages:
        data = (html or "").encode()
        ids = [p for p in first[html or ""] if p is not None]
        low = min(ids) if ids else None
        revisit = len(first[html or ""]) > 1 and page != low
        rows.append((page, len(data), sha(data), "revisit" if revisit else "response", low if revisit else None))
    return sorted(rows, key=repr)


def test_query(spark):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    rows = QUERIES["op4_warc"](spark, SF)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, rows.select(names).collect()), key=repr) == expected(pages)


def test_hard_pages(spark):
    pages = [
        (5, "http://a/\r\nX: y", "same"), (3, None, "same"), (9, "u", "same"), (None, "u", "same"),
        (1, "u", None), (2, "u", ""), (4, "u", "é🙂\r\n\r\nWARC/1.1\r\n\x00" * 50), (None, "u", "alone"),
        (6, "u", "x" * (9 << 20)), (7, "u", "twice"), (7, "u", "twice"), (8, "u", "twice"),
    ]
    df = spark.createDataFrame([(*p, "s") for p in pages], "page_id long, url string, html string, sha string")
    found = warc.read_records(spark, warc.write_pages(df)).collect()
    assert {r["kind"] for r in found} == {"record"}
    rows = [
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["warc_type"], r["refers_to_page"]) for r in found
    ]
    assert sorted(rows, key=repr) == expected([(p, h) for p, _, h in pages])
    stored = {r["page_id"]: r["payload"] for r in found if r["warc_type"] == "response"}
    assert stored[4].decode() == pages[6][2] and stored[3] == b"same"


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_records(spark, warc.write_pages(df)).count() == 0


def archive(packed):
    parts = []
    for i in range(5):
        data = warc.record(i, "u", f"page {i} ".encode() * 40, sha(f"page {i} ".encode() * 40), False, None)
        parts.append(warc.members(data) if packed else data)
    return parts


def test_members_are_plain_gzip():
    parts = archive(True)
    assert gzip.decompress(b"".join(parts)).count(b"WARC-Type: response") == 5


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("harm", ["flip", "cut", "junk", "head"])
def test_salvage(packed, harm):
    parts = archive(packed)
    third = parts[2]
    middle = len(third) - 40
    parts[2] = {
        "flip": third[:middle] + bytes([third[middle] ^ 1]) + third[middle + 1 :],
        "cut": third[:middle],
        "junk": b"\x1f\x8b\x08 no member, WARC/1.x neither" + third,
        "head": third[8:],
    }[harm]
    data = b"".join(parts)
    rows = list(warc.salvaged(data))
    pages = [r["page_id"] for r in rows if r["kind"] == "record"]
    assert pages == ([0, 1, 2, 3, 4] if harm == "junk" else [0, 1, 3, 4])
    gaps = [r for r in rows if r["kind"] == "gap"]
    assert gaps and all(g["reason"] for g in gaps)
    assert sum(r["length"] for r in rows) == len(data)


def test_every_cut_of_an_archive_keeps_the_records_before_it():
    parts = archive(True)
    data = b"".join(parts)
    for end in range(0, len(data), 37):
        rows = list(warc.salvaged(data[:end]))
        whole = sum(1 for i in range(1, 6) if len(b"".join(parts[:i])) <= end)
        assert [r["page_id"] for r in rows if r["kind"] == "record"] == list(range(whole))
        assert sum(r["length"] for r in rows) == end


def test_headers_of_any_length():
    """A plain record whose headers are far longer than one read is no gap."""
    for size in (65_536, 70_000, 400_000):
        url = "http://x/" + "u" * size
        sha = warc.digest(b"body")
        data = warc.record(5, url, b"body", sha, False, None) + warc.record(6, "http://y", b"body", sha, False, None)
        rows = list(warc.salvaged(data))
        assert [(r["kind"], r["page_id"]) for r in rows] == [("record", 5), ("record", 6)]
        assert rows[0]["target"] == url


@pytest.mark.parametrize("most", [1, 200_000, 10**9])
def test_files_are_bounded_by_packed_bytes(spark, tmp_path, most):
    rng = random.Random(1)
    pages = [(i, "u", "".join(map(chr, rng.choices(range(0x20, 0x2000), k=rng.randrange(40_000))))) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    path = warc.write_pages(df, path=str(tmp_path / "w"), file_bytes=most)
    sizes = [p.stat().st_size for p in (tmp_path / "w").rglob("part-*")]
    longest = max(len(warc.members(warc.record(i, u, h.encode(), sha(h.encode()), False, None))) for i, u, h in pages)
    assert max(sizes) < most + longest and len(sizes) <= 2 * sum(sizes) / most + 1
    found = warc.read_records(spark, path).collect()
    assert {r["kind"] for r in found} == {"record"}
    assert sorted((r["page_id"], r["payload"].decode()) for r in found) == [(i, h) for i, _, h in pages]


def quoting(i, harm):
    """A plain record whose payload quotes another, one byte of it wrong or a piece of it missing."""
    quoted = warc.record(77, "q", b"quoted", sha(b"quoted"), False, None)
    body = f"page {i} ".encode() * 20 + quoted + b"end" * 20
    data = warc.record(i, "u", body, sha(body), False, None)
    at = data.index(b"end" * 3)
    return data[:at] + {"flip": b"x", "none": b"e"}[harm] + data[at + 1 :] if harm != "cut" else data[:at] + data[at + 9 :]


@pytest.mark.parametrize("harms", ["none flip none", "flip none", "none flip", "flip flip none", "flip", "none cut none"])
def test_a_quoted_record_is_none_of_the_archive(harms):
    """Unless a record's length is wrong, what it quotes stays in its gap."""
    harms = harms.split()
    data = b"".join(quoting(i, harm) for i, harm in enumerate(harms))
    rows = list(warc.salvaged(data))
    pages = [r["page_id"] for r in rows if r["kind"] == "record"]
    good = [i for i, harm in enumerate(harms) if harm == "none"]
    if "cut" in harms:
        assert [p for p in pages if p != 77] == good  # the quotation may be found, no page is lost
    else:
        assert pages == good
        assert [r["reason"] for r in rows if r["kind"] == "gap"] == ["block digest differs"] * harms.count("flip")
    assert sum(r["length"] for r in rows) == len(data)
