"""WARC round trip: records, duplicates, streams of every form, offsets."""

import base64
import gzip
import hashlib
import json
import random
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featuremart.llm import queries, warc
from tools.oracle_check import compare, duck_connect

SCHEMA = "page_id long, url string, html string, w_row string, type int"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) of each row."""
    groups = {}
    for i, (page, _, html) in enumerate(rows):
        groups.setdefault(html or "", []).append((-1 if page is None else page, i))
    out = []
    for html, members in groups.items():
        n = len(html.encode())
        top = max(members)[0]
        top = None if top < 0 else top
        for k, (page, _) in enumerate(sorted(members, reverse=True)):
            page = None if page < 0 else page
            again = k > 0 and n >= least
            out.append((page, n, digest(html), "revisit" if again else "response", top if again else None))
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


def result(df):
    return Counter((None if r.key is None else int(r.key), r.bytes, r.digest, r.type,
                    None if r.refers_to is None else int(r.refers_to)) for r in df.collect())


def odd_rows():
    rng = random.Random(1)
    rows = [(i, f"http://a.example/{i}", rng.choice(["<p>a</p>", "<p>b\r\n\r\nWARC/1.1\r\n</p>", "é" * 50, f"own {i}"])) for i in range(200)]
    rows += [(300 + i, "http://hot.example/", "hot") for i in range(150)]
    rows += [(500, None, None), (501, "u", ""), (502, "u", None), (503, "http://x/\r\nWARC-Type: fake", "break"),
             (None, "u", "lone"), (None, "u", "hot"), (None, "u", "nulls"), (None, "u", "nulls"),
             (504, "u", "same"), (504, "u", "same"), (504, "v", "same"), (505, "u", "x" * 3_000_000),
             (506, "u", "x" * 3_000_000), (507, "u", "ends in breaks\r\n\r\n\r\n")]
    return rows


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip_matches_brute_force(spark, least):
    rows = odd_rows()
    assert result(warc.round_trip(frame(spark, rows).repartition(3), min_revisit=least)) == brute(rows, least)


def test_payloads_and_urls_come_back(spark):
    rows = odd_rows()
    got = warc.round_trip(frame(spark, rows)).where(F.col("type") == "response").collect()
    assert {bytes(r.payload).decode() for r in got} == {h or "" for _, _, h in rows}
    assert {r.target for r in got if r.key == "503"} == {"http://x/%0D%0AWARC-Type: fake"}
    assert {r.target for r in got if r.digest == digest("")} <= {"u", "about:blank"}


def test_empty_table(spark):
    assert result(warc.round_trip(frame(spark, []))) == Counter()


def test_files_are_monolithic_then_a_member_a_record(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"<p>{i}</p>" * 30) for i in range(40)]
    warc.write_monolithic(frame(spark, rows).coalesce(1), str(tmp_path / "in"), records_per_archive=15)
    files = sorted((tmp_path / "in").glob("*.gz"))
    assert len(files) == 3
    for f in files:                     # one member holds all records of the file
        inflater = __import__("zlib").decompressobj(31)
        assert inflater.decompress(f.read_bytes()).count(b"WARC/1.1\r\n") in (15, 10) and not inflater.unused_data
    done = warc.normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert done.agg(F.sum("records")).first()[0] == 40
    for f in files:
        name = f.name.split(".")[0]
        raw = (tmp_path / "out" / f"{name}.warc.gz").read_bytes()
        assert gzip.decompress(raw) == gzip.decompress(f.read_bytes())
        lines = [json.loads(x) for x in (tmp_path / "out" / f"{name}.index.jsonl").read_text().splitlines()]
        assert [x["offset"] for x in lines] == [sum(y["length"] for y in lines[:k]) for k in range(len(lines))]
        assert sum(x["length"] for x in lines) == len(raw)
        for x in lines:                 # every member can be read alone
            one = gzip.decompress(raw[x["offset"]:x["offset"] + x["length"]])
            assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n") and x["id"].encode() in one


def record(payload: bytes, name="<urn:x>", version="WARC/1.0"):
    return f"{version}\r\nWARC-Type: resource\r\nwarc-record-id: {name}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


def test_streams_of_every_form(tmp_path):
    records = [record(b"a\r\n\r\nWARC/1.1"), record(b""), record(bytes(range(256)) * 5000), record(b"\r\n\r\n")]
    plain = b"".join(records)
    forms = {"one": gzip.compress(plain), "each": b"".join(map(gzip.compress, records)), "none": plain,
             "split": gzip.compress(plain[:50]) + gzip.compress(plain[50:]), "empty": gzip.compress(b""), "bare": b""}
    for name, raw in forms.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(raw)
        _, n, size = warc.normalise_file(str(tmp_path / f"{name}.warc.gz"), str(tmp_path / "."))
        first = (tmp_path / f"{name}.warc.gz").read_bytes()      # normalised in place of the source
        assert n == (0 if name in ("empty", "bare") else 4) and len(first) == size
        assert gzip.decompress(first) == (b"" if n == 0 else plain) if first else n == 0
        assert warc.normalise_file(str(tmp_path / f"{name}.warc.gz"), str(tmp_path))[1:] == (n, size)
        assert (tmp_path / f"{name}.warc.gz").read_bytes() == first  # the same bytes again
    assert not list(tmp_path.glob("_*"))


@pytest.mark.parametrize("raw, what", [
    (gzip.compress(record(b"x" * 5000))[:-9], "cut off"), (gzip.compress(record(b"abc")[:-6]), "cut off"),
    (gzip.compress(b"<html>" * 100), "no WARC"), (gzip.compress(b"HTTP/1.1 200\r\nA: b\r\n\r\n"), "not a WARC"),
    (gzip.compress(b"WARC/1.1\r\nWARC-Type: x\r\n\r\n"), "invalid literal"),
    (gzip.compress(record(b"abc")) + b"zz", "damaged")])
def test_damaged_files_are_named(tmp_path, raw, what):
    path = tmp_path / "bad.warc.gz"
    path.write_bytes(raw)
    with pytest.raises(ValueError, match="bad.warc.gz") as e:
        warc.normalise_file(str(path), str(tmp_path / "."))
    assert what in str(e.value)


def test_memory_does_not_follow_the_record(tmp_path):
    path = tmp_path / "long.gz"
    with gzip.open(path, "wb", 1) as f:
        n = 200 << 20
        f.write(f"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: {n}\r\n\r\n".encode())
        for _ in range(200):
            f.write(b"z" * (1 << 20))
        f.write(b"\r\n\r\n")
    tracemalloc.start()
    assert warc.normalise_file(str(path), str(tmp_path))[1] == 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20


def test_a_wrong_index_is_noticed(spark, tmp_path):
    rows = [(i, "u", f"<p>{i}</p>") for i in range(5)]
    warc.write_monolithic(frame(spark, rows).coalesce(1), str(tmp_path / "in"))
    warc.normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    index = warc.read_index(spark, str(tmp_path / "out"))
    assert warc.read_records(index, str(tmp_path / "out")).count() == 5
    for wrong in (F.col("offset") + 1, F.col("offset") * 0):
        with pytest.raises(Exception, match="gzip member|the index names|header check"):
            warc.read_records(index.withColumn("offset", wrong), str(tmp_path / "out")).collect()


def test_query_against_sql(spark):
    path = "/root/testdata/sf0.01"
    r = compare(spark, duck_connect(path), "op12", queries.op12_warc_normaliser, queries.ORACLES["op12_warc_normaliser"], path)
    assert r["status"] == "OK" and not r.get("types") and r["spark_rows"] > 0, r
