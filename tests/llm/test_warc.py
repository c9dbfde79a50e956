import gzip
import hashlib

import pytest

from siteweave.llm import warc
from siteweave.session import new_table_path

PAGES = "page_id long, url string, html string, digest string"
LONG = "<p>" + "é" * 60 + "</p>"
ROWS = [
    (3, "http://a/\r\nX-Evil: 1", LONG, "clash"),
    (1, "http://b/?q=ü", LONG, None),
    (2, None, "short", "x"),
    (4, "http://c/", "short", "x"),
    (5, "http://d/", None, "x"),
    (6, "", "", "x"),
    (7, "http://e/", "y" * 300_000 + "\r\n\r\nmore", "x"),
    (None, "http://f/", LONG, "x"),
    (None, None, "z" * 100, "x"),
    (8, "http://g/", "w" * 100, "x"),
    (8, "http://g/", "w" * 100, "x"),
    (8, "http://a/", "w" * 100, "x"),
]


def expected(rows):
    out = []
    for page_id, _, html, _ in rows:
        raw = (html or "").encode()
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture
def stored(llm):
    path = new_table_path(llm, "warc")
    return llm.createDataFrame(ROWS, PAGES).repartition(3), path


def test_round_trip(stored):
    pages, path = stored
    index = warc.write_archives(pages, path)
    records = warc.read_records(index, path).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest) for r in records), key=repr) == expected(ROWS)
    responses = {r.payload_digest: r for r in records if r.record_type == "response" and r.payload_bytes >= 100}
    large = [r for r in records if r.payload_bytes >= 100]
    assert len(responses) == len({r.payload_digest for r in large})
    for r in records:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest and r.refers_to is None
        else:
            assert r.payload is None and r.payload_bytes >= 100
            assert r.refers_to == responses[r.payload_digest].page_id
    firsts = {r.payload_digest: r.page_id for r in responses.values()}
    assert firsts[hashlib.sha256(LONG.encode()).hexdigest()] == 1
    # Rows that share the smallest id are all responses, as the SQL of the query says.
    assert sum(r.record_type == "revisit" for r in records) == 2
    assert sum(r.page_id == 8 and r.record_type == "response" for r in records) == 3


def test_archives_are_valid_members(stored, llm):
    pages, path = stored
    index = warc.write_archives(pages, path).collect()
    for row in index:
        store, folder = warc._open(f"{path}/archives")
        with store.open_input_file(f"{folder}/{row.archive}") as f:
            record = gzip.decompress(f.read_at(row.length, row.start))
        head, _, block = record.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and b"\nX-Evil" not in head
        length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert block[length:] == b"\r\n\r\n"


def test_only_selected_records_are_read(stored, llm):
    pages, path = stored
    warc.write_archives(pages, path)
    chosen = warc.read_index(llm, path).filter("page_id = 7")
    (record,) = warc.read_records(chosen, path).collect()
    assert bytes(record.payload).decode() == ROWS[6][2]


def test_a_damaged_record_is_an_error(stored, llm):
    pages, path = stored
    index = warc.write_archives(pages, path).filter("payload_bytes > 0 AND record_type = 'response'")
    wrong = index.selectExpr("archive", "start + 1 AS start", "length - 1 AS length").limit(1)
    with pytest.raises(Exception, match="(?i)incorrect header|error"):
        warc.read_records(wrong, path).collect()


def test_empty_table(llm):
    assert warc.archive_round_trip(llm.createDataFrame([], PAGES)).count() == 0


def test_ranges_join_near_records_only():
    spans = [(0, 10), (10, 10), (500, 5), (600, 3000), (3700, 10)]
    got = list(warc.coalesce_ranges(spans, gap=100, most=1000))
    assert [g for *_, g in got] == [[(0, 10), (10, 10)], [(500, 5)], [(600, 3000)], [(3700, 10)]]
    assert list(warc.coalesce_ranges([])) == []
