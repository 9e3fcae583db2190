"""WARC archives: round trip and revisit resolution against brute force."""

import base64
import gzip
import hashlib
from collections import Counter

from aevia.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, file string, content string, at int"
HTML = ["<p>one</p>", "<p>two</p>\r\n\r\nWARC/1.1\r\n", "é✓" * 50_000, "", None]


def odd_rows():
    rows = [(n, None if n % 4 == 3 else f"http://h/{n}\r\nX: y", HTML[n % 5]) for n in range(40, 0, -1)]
    rows += [(3, "a", HTML[0]), (3, "a", HTML[0]), (None, "b", HTML[1]), (None, "b", "only without ids"), (None, None, "only without ids")]
    rows += [(100 + n, None, f"own {n}") for n in range(9)]
    return rows


def brute(rows, min_bytes=0):
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = Counter()
    for payload, pages in groups.items():
        pages.sort(key=lambda p: (p is None, p or 0))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for k, page in enumerate(pages):
            again = k and len(payload) >= min_bytes
            out[page, len(payload), digest, "revisit" if again else "response", pages[0] if again else None] += 1
    return out


def got(spark, path):
    return Counter(map(tuple, warc.resolved(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))


def pages_of(llm, rows):
    return llm.createDataFrame([(*r, "d", None, "c", 1) for r in rows], SCHEMA).repartition(3)


def test_revisits_against_brute_force(llm, scratch):
    warc.write_responses(pages_of(llm, odd_rows()), f"{scratch}/raw", file_bytes=200)
    assert sum(got(llm, f"{scratch}/raw").values()) == len(odd_rows())
    for n in (0, 3, 1 << 20):
        warc.deduplicate(llm, f"{scratch}/raw", f"{scratch}/own{n}", min_bytes=n)
        assert got(llm, f"{scratch}/own{n}") == brute(odd_rows(), n)


def test_archives_are_plain_warc(llm, scratch):
    """Any gzip reader opens the files; headers name the original, and only
    responses hold payloads."""
    warc.write_responses(pages_of(llm, odd_rows()), f"{scratch}/raw")
    warc.deduplicate(llm, f"{scratch}/raw", f"{scratch}/own")
    files = [bytes(r["content"]) for r in llm.read.format("binaryFile").load(f"{scratch}/own").collect()]
    text = b"".join(map(gzip.decompress, files))
    records = [warc.parse(m) for f in files for m in warc.members(f)]
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(records) == len(odd_rows())
    ids = {r.id: r for r in records}
    assert len(ids) == len(records)
    for r in records:
        assert r.uri is None or ("\r" not in r.uri and "\n" not in r.uri)
        if r.kind == "revisit":
            assert not r.payload and ids[r.refers_to].digest == r.digest and ids[r.refers_to].uri == r.refers_uri
        else:
            assert warc.payload_digest(r.payload) == r.digest and r.length == len(r.payload)


def test_archives_with_revisits_are_resolved_again(llm, scratch):
    """An archive of archives: revisit records go to the one original, and
    one without a response stays."""
    one = warc.Record("response", "<a>", 7, "u", warc.payload_digest(b"x"), b"x", length=1)
    rows = [one, warc.Record("revisit", "<b>", 2, "v", one.digest, refers_to="<gone>", length=1),
            warc.Record("response", "<c>", 5, None, one.digest, b"x", length=1),
            warc.Record("revisit", "<d>", 9, "w", "NOWHERE", refers_to="<lost>", length=4)]
    data = b"".join(r.member() for r in rows)
    warc._write_files(llm.createDataFrame([(data,)], "value binary"), f"{scratch}/raw")
    warc.deduplicate(llm, f"{scratch}/raw", f"{scratch}/own")
    assert got(llm, f"{scratch}/own") == Counter([
        (5, 1, one.digest, "response", None), (7, 1, one.digest, "revisit", 5), (2, 1, one.digest, "revisit", 5),
        (9, None, "NOWHERE", "revisit", None)])


def test_one_payload_on_a_third_of_all_pages(llm, scratch):
    rows = [(n, f"u{n}", "same" if n % 3 == 0 else f"own {n}") for n in range(3000)]
    warc.write_responses(pages_of(llm, rows), f"{scratch}/raw", file_bytes=5_000)
    warc.deduplicate(llm, f"{scratch}/raw", f"{scratch}/own")
    assert got(llm, f"{scratch}/own") == brute(rows)


def test_no_pages(llm, scratch):
    warc.write_responses(pages_of(llm, []), f"{scratch}/raw")
    warc.deduplicate(llm, f"{scratch}/raw", f"{scratch}/own")
    assert got(llm, f"{scratch}/own") == Counter()
