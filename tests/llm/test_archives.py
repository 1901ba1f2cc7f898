"""Archives: written, read back and assembled, against a plain reading of the pages."""

import gzip
import hashlib
from collections import Counter

import pytest

from tamiz.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, revisit string, _first int, record_id string, n string"


def pages():
    long = "x" * 200
    rows = [(1, "u", long), (1, "u", long), (0, "v", long), (0, "v", long), (0, "v", long), (None, None, long), (0, "w", long)]
    rows += [(None, None, None), (4, None, ""), (5, "a\r\nb", "s"), (6, "a", "s"), (12, "né 漢", "Ünï 😀 " * 20)]
    rows += [(7, "z", "y\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 20 + "é"), (8, "z", "q" * 99), (9, "z", "q" * 99)]
    rows += [(10, None, "p\r\n\r\n" * 50), (11, "k", "\r\n" * 51), (13, "k", "\r\n" * 51), (14, "long", "tail\r\n" * 300_000)]
    return rows + [(20 + k, "t", "é" * 50) for k in range(4)] + [(30 + k, "t", "é" * 49) for k in range(2)]


def expected(rows):
    made, by = Counter(), {}
    for row in rows:
        by.setdefault(row[2] or "", []).append(row)
    for html, own in by.items():
        raw = html.encode()
        own.sort(key=lambda r: (r[0] is None, r[0], r[1] is None, r[1]))
        for k, (page, _, _) in enumerate(own):
            again = k > 0 and len(raw) >= 100
            made[page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", own[0][0] if again else None] += 1
    return made


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1, "c", "d") for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("rows", [pages(), [], [(None, None, None)]], ids=["odd", "none", "null"])
def test_round_trip(spark, tmp_path, rows):
    table_of(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    made = warc.op12_transaction_assembly(spark, str(tmp_path))
    assert Counter(tuple(r) for r in made.collect()) == expected(rows)
    assert made.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_payloads_come_back_whole(spark, tmp_path):
    warc.write_archives(table_of(spark, pages()), f"{tmp_path}/a")
    records = warc.read_records(spark, f"{tmp_path}/a")
    kinds = Counter(r.type for r in records.collect())
    assert kinds["request"] == kinds["metadata"] == kinds["response"] + kinds["revisit"] == len(pages())
    assert len({r.record_id for r in records.collect()}) == sum(kinds.values())
    rows = warc.captures(records).collect()
    assert len(rows) == len(pages()) and all(len(r.requests) == len(r.metadata) == 1 for r in rows)
    texts = Counter(bytes(r.payload).decode() for r in rows if r.type == "response")
    assert set(texts) == {t or "" for _, _, t in pages()}
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest == r.declared_digest[7:] for r in rows if r.type == "response")


def text_of(kind, name, block, *fields, size=None):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *fields, f"Content-Length: {len(block) if size is None else size}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """A gzip member per record, links in the response, several requests, orphans, and damaged records."""
    http = "Content-Type: application/http"
    parts = [
        text_of("warcinfo", "i", b"software: x\r\n"),
        text_of("response", "r1", b"HTTP/1.1 200 OK\r\n\r\nbody", http, "WARC-Concurrent-To: <q1>", "WARC-Concurrent-To: <q2>", "warc-concurrent-to: <m1>"),
        text_of("request", "q1", b"GET /", http),
        text_of("request", "q2", b"GET /2", http, "WARC-Concurrent-To: <r1>"),
        text_of("metadata", "m1", b"via: y\r\nhops: 2\r\n\r\n"),
        text_of("response", "bad", b"cut short", http, size=4),
        text_of("response", "r2", b"", http),
        text_of("request", "orphan", b"GET /", http, "WARC-Concurrent-To: <none>"),
        b"no header at all\r\n\r\n",
        text_of("response", "r3", b"no header", size=0)[:-13],
    ]
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "empty.warc.gz").write_bytes(gzip.compress(b""))
    (tmp_path / "tail.warc.gz").write_bytes(gzip.compress(parts[1] + text_of("response", "last", b"long" * 9, size=99)))
    records = warc.read_records(spark, str(tmp_path)).cache()
    kinds = Counter(r.type for r in records.collect())
    assert kinds == {"warcinfo": 1, "response": 4, "request": 3, "metadata": 1, "unreadable": 3}
    whole = records.filter("record_id <> '<r1>' OR record_id IS NULL").unionByName(records.filter("record_id = '<r1>'").limit(1))
    rows = {r.record_id: r for r in warc.captures(whole).collect()}
    assert set(rows) == {"<r1>", "<r2>", "<r3>"} and rows["<r1>"].payload == b"body" and rows["<r2>"].payload_bytes == 0
    assert [q.record_id for q in rows["<r1>"].requests] == ["<q1>", "<q2>"]
    assert rows["<r1>"].metadata[0].fields == {"via": "y", "hops": "2"} and not rows["<r2>"].metadata


def test_an_archive_that_begins_inside_a_record_is_refused():
    with pytest.raises(ValueError, match="compressed"):
        list(warc.records_of(iter([b"tail of a record", b"WARC/1.0"])))
