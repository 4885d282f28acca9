from __future__ import annotations

import gzip
import hashlib
import random

import oracle

from lakekit.llm import catalog, warc


def record(body: bytes, kind: str = "response") -> bytes:
    digest = hashlib.sha256(body).hexdigest()
    head = f"WARC-Type: {kind}\r\nWARC-Payload-Digest: sha256:{digest}\r\nWARC-Block-Digest: sha256:{digest}\r\n"
    return warc.VERSION + f"{head}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def parts(data: bytes):
    found = list(warc.salvage(data))
    assert [p.start for p in found] == [0, *[p.end for p in found]][: len(found)] and (not found or found[-1].end == len(data))
    return [p.block if isinstance(p, warc.Record) else p.reason for p in found]


BODIES = [b"one", b"", b"WARC/1.1\r\nnot a record\r\n\r\n", b"four " * 1000]


def test_round_trip_plain_and_gzip():
    for wrap in (bytes, gzip.compress):
        assert parts(b"".join(wrap(record(b)) for b in BODIES)) == BODIES
    assert parts(b"") == []


def test_later_records_come_back_after_damage():
    for wrap in (bytes, gzip.compress):
        good = [wrap(record(b)) for b in BODIES]
        for i in range(4):
            broken = list(good)
            broken[i] = broken[i][: len(broken[i]) // 2]
            got = parts(b"".join(broken))
            assert [b for b in got if b in BODIES] == [b for j, b in enumerate(BODIES) if j != i]
        got = parts(b"junk" + good[0] + b"\0" * 9 + good[3] + b"tail")
        assert got[1] == BODIES[0] and got[3] == BODIES[3] and len(got) == 5
    changed = record(b"abcdef" * 50).replace(b"fabc", b"fXbc", 1)
    assert parts(record(b"x") + changed + record(b"y")) == [b"x", "block digest differs", b"y"]


def test_members_of_many_records():
    whole = gzip.compress(b"".join(record(b"r%d" % i) for i in range(500)))
    assert parts(whole + gzip.compress(record(b"z"))) == [b"r%d" % i for i in range(500)] + [b"z"]
    got = parts(whole[: len(whole) // 2] + gzip.compress(record(b"z")))
    assert got[:100] == [b"r%d" % i for i in range(100)] and got[-1] == b"z" and "gzip" in got[-2]


def test_random_damage_never_loses_other_records():
    rng = random.Random(1)
    records = [record(rng.randbytes(rng.randrange(300))) for _ in range(20)]
    for _ in range(200):
        i = rng.randrange(20)
        hurt = bytearray(records[i])
        hurt[rng.randrange(len(hurt))] ^= 1 << rng.randrange(8)
        found = {p.block for p in warc.salvage(b"".join([*records[:i], bytes(hurt), *records[i + 1 :]])) if isinstance(p, warc.Record)}
        assert {warc.parse_record(r, 0).block for j, r in enumerate(records) if j != i} <= found


def test_odd_pages(spark, tmp_path):
    body = "<html>" + "é" * 80
    rows = [(3, "u", body), (1, "u\r\nx", body), (2, None, body), (1, "u", body), (None, "u", body), (None, "u", None)]
    rows += [(7, "u", "short"), (8, "u", "short"), (9, "u", ""), (10, "u", "x" * 300_000), (11, "u", warc.VERSION.decode() + "\n" * 90)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, records_per_file=4)
    got = warc.read_archives(spark, path).collect()
    assert {r["kind"] for r in got} == {"record"} and all(r["intact"] in (True, None) for r in got)
    ids = [(r["record_id"], r["type"], r["refers_to"], r["payload_bytes"]) for r in got]
    wanted = [("3", "revisit", "1", 166), ("1", "response", None, 166), ("2", "revisit", "1", 166)]
    wanted += [("1", "response", None, 166), (None, "revisit", "1", 166), (None, "response", None, 0)]
    wanted += [("7", "response", None, 5), ("8", "response", None, 5), ("9", "response", None, 0)]
    wanted += [("10", "response", None, 300_000), ("11", "response", None, 100)]
    assert sorted(ids, key=repr) == sorted(wanted, key=repr)
    payloads = {r["payload"] for r in got if r["payload"] is not None}
    assert payloads == {(h or "").encode() for _, _, h in rows}
    warc.write_archives(pages.limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def test_gaps_are_logged_by_file(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(b"1") + b"broken" + record(b"2"))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record(b"3")) + gzip.compress(record(b"4"))[:-5])
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(bytes(r["payload"]) for r in got if r["kind"] == "record") == [b"1", b"2", b"3", b"4"]
    gaps = [(r["file"].rpartition("/")[2], r["end"] - r["start"]) for r in got if r["kind"] == "gap"]
    assert sorted(gaps) == [("a.warc", 6), ("b.warc.gz", len(gzip.compress(record(b"4"))) - 5)]


def test_query_against_sql(spark, db, folder):
    got = oracle.spark_rows(catalog.QUERIES["op6_warc_salvage"](spark, folder))
    assert got == oracle.duckdb_rows(db, catalog.ORACLES["op6_warc_salvage"])


def test_damage_in_a_written_file_costs_one_record(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, "u", f"<p>{rng.randbytes(200).hex()}</p>" if i % 3 else "<p>again and again</p>" * 9) for i in range(60)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    files = [f.read_bytes() for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    ids = lambda data: {p.headers["warc-record-id"] for p in warc.salvage(data) if isinstance(p, warc.Record)}
    assert sum(len(ids(f)) for f in files) == 60
    assert all(gzip.decompress(f).count(warc.VERSION) == len(ids(f)) for f in files)
    for data in files:
        for at in rng.sample(range(len(data)), min(20, len(data))):
            hurt = bytearray(data)
            hurt[at] ^= 1 << rng.randrange(8)
            assert len(ids(data) - ids(bytes(hurt))) <= 1


def test_members_end_in_zero_at_any_size():
    for body in (b"x", b"x" * (1 << 24)):
        data = warc.gzip_member(record(body)) + b"\0" + warc.gzip_member(record(b"z")) + b"\0"
        assert [p.block for p in warc.salvage(data)] == [body, b"z"]
