"""Archives: round trip against SQL, and salvage after damage."""

from __future__ import annotations

import io
import random
import re
import tracemalloc

import pytest

from forespell.llm import queries, warc
from forespell.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


def records():
    pages = [(k, f"http://x/{k}", f"<p>{k}</p>".encode() * random.Random(k).randint(0, 9000)) for k in range(60)]
    return [warc.record(k, u, p, "response", None, warc.digest(p)) for k, u, p in pages]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    parts = [warc.member(r) if packed else r for r in records()]
    starts = [sum(map(len, parts[:k])) for k in range(61)]
    whole = b"".join(parts)
    reader = warc.Salvage(io.BytesIO(whole))
    assert [at for at, _, _ in reader] == starts[:-1] and not reader.gaps
    broken = bytearray(whole)
    broken[starts[11] - 9] ^= 0xFF
    broken[starts[20] : starts[20] + 8] = b"12345678"
    broken = bytes(broken[: starts[40]]) + b"WARC?" * 500 + bytes(broken[starts[40] : -30])
    reader = warc.Salvage(io.BytesIO(broken))
    good = [int(h["warc-record-id"][10:-1]) for _, h, _ in reader]
    assert good == [k for k in range(59) if k not in (10, 20)]
    assert [(a, b) for a, b, _ in reader.gaps] == [(starts[10], starts[11]), (starts[20], starts[21]), (starts[40], starts[40] + 2500), (starts[59] + 2500, len(broken))]
    assert list(warc.Salvage(io.BytesIO(b""))) == [] and list(warc.Salvage(io.BytesIO(b"nothing here"))) == []


def ids(reader):
    return [int(h["warc-record-id"][10:-1]) for _, h, _ in reader]


def test_many_records_in_a_member():
    made = records()
    whole = warc.member(b"".join(made[:5])) + warc.member(b"".join(made[5:]))
    reader = warc.Salvage(io.BytesIO(whole))
    assert ids(reader) == list(range(60)) and not reader.gaps
    inside = bytearray(b"".join(made[:5]))
    inside[len(made[0]) + len(made[1]) + 3] ^= 0xFF
    first = warc.member(bytes(inside))
    reader = warc.Salvage(io.BytesIO(first + made[7] + warc.member(made[8])))
    assert ids(reader) == [0, 1, 3, 4, 7, 8]
    (gap,) = reader.gaps
    assert gap[:2] == (0, len(first)) and f"bytes {len(made[0] + made[1])} to {len(made[0] + made[1] + made[2])} of" in gap[2]


def test_damaged_member_keeps_what_is_before_the_damage():
    pages = [(k, random.Random(k).randbytes(40_000).hex().encode()) for k in range(8)]
    made = [warc.record(k, "u", p, "response", None, warc.digest(p)) for k, p in pages]
    packed = bytearray(warc.member(b"".join(made)))
    packed[len(packed) * 5 // 8 + 2000] ^= 0xFF
    reader = warc.Salvage(io.BytesIO(bytes(packed) + warc.member(made[7])))
    got = ids(reader)
    assert got[-1] == 7 and got[:-1] == list(range(len(got) - 1)) and len(got) >= 4
    assert [(a, b) for a, b, _ in reader.gaps] == [(0, len(packed))]


@pytest.mark.parametrize("kind", ["zeros", "magic", "random"])
def test_long_gap_in_bounded_memory(kind):
    made = records()
    junk = {"zeros": bytes(48 << 20), "magic": b"\x1f\x8b\x08" * (1 << 20), "random": random.Random(1).randbytes(48 << 20)}[kind]
    whole = io.BytesIO(made[1] + junk + warc.member(made[2]))
    tracemalloc.start()
    reader = warc.Salvage(whole)
    assert ids(reader) == [1, 2]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(a, b) for a, b, _ in reader.gaps] == [(len(made[1]), len(made[1]) + len(junk))]
    assert peak < 4 << 20


def test_wrong_lengths_are_not_read_to_their_end():
    made = records()
    real = re.search(rb"Content-Length: (\d+)\r\n\r\nHTTP", made[1])[1]
    for wrong in (b"30000000", b"999999999999999", b"9" * 5000, b"1"):
        bad = made[1].replace(b"Content-Length: " + real + b"\r\n\r\nHTTP", b"Content-Length: " + wrong + b"\r\n\r\nHTTP")
        for whole in (bad + made[2] + bytes(40 << 20), warc.member(bad + made[2] + bytes(1 << 20))):
            whole = io.BytesIO(whole)
            tracemalloc.start()
            assert ids(warc.Salvage(whole)) == [2]
            assert tracemalloc.get_traced_memory()[1] < 4 << 20
            tracemalloc.stop()


def test_query_against_plain_python(spark):
    pages = queries.table(spark, SF_DIR, "pages").collect()
    first: dict = {}
    for r in sorted(pages, key=lambda r: r["page_id"]):
        first.setdefault(r["html"], r["page_id"])
    want = {}
    for r in pages:
        body = (r["html"] or "").encode()
        to = first[r["html"]]
        want[r["page_id"]] = (len(body), warc.digest(body), "response" if to == r["page_id"] else "revisit", None if to == r["page_id"] else to)
    assert {r[0]: tuple(r)[1:] for r in queries.op6_warc(spark, SF_DIR).collect()} == want


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, payload string, sha string, first long"
    rows = [(3, "u", "same"), (1, None, "same"), (None, "u v\r\n", "same"), (1, "u", "same"), (5, "u", None), (6, "u", ""), (None, "u", "only"), (7, "u", "x" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "p", "s", 1) for r in rows], schema)
    got = [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.round_trip(pages).collect()]
    want = [(3, "revisit", 1, 4), (1, "response", None, 4), (1, "response", None, 4), (None, "revisit", 1, 4), (5, "response", None, 0), (6, "revisit", 5, 0), (None, "response", None, 4), (7, "response", None, 3_000_000)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.round_trip(pages.filter("false")).count() == 0
    files = warc.write(pages, scratch_path(spark, "warc"), least=10)
    texts = [r["payload"].decode() for r in warc.read(files).collect()]
    assert sorted(texts) == sorted((r[2] or "") for r in rows)
