import base64
import gzip
import hashlib
import io
import random

import pytest

from copse.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string"


def fixture():
    rnd = random.Random(8)
    body = lambda n: "".join(rnd.choice("<a>é\r\n 日b") for _ in range(n))
    rows = [(i, f"http://x/{i}", body(rnd.choice([0, 3, 200, 3000])), "z") for i in range(60)]
    rows += [(100 + i, None, rows[7][2], "z") for i in range(20)]
    rows += [(i, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n", "z") for i in (203, 201, 202)]
    rows += [(300, "u\r\nX-Page-ID: 9", None, "z"), (301, "", "", "z"), (None, "v", "only without id", "z"),
             (None, "v", "only without id", "z"), (None, "w", rows[7][2], "z"), (400, "a", "twice", "z"),
             (400, "a", "twice", "z"), (400, "b", "twice", "z"), (500, "long", body(3_000_000), "z")]
    return rows


def brute(rows, least=0):
    data = [((r[2] or "").encode(), r) for r in rows]
    out, groups = [], {}
    for i, (p, r) in enumerate(data):
        groups.setdefault(p, []).append((r[0] is None, r[0] or 0, r[1] is None, r[1] or "", i))
    for i, (p, r) in enumerate(data):
        first = min(groups[p])[-1]
        revisit = len(p) >= least and first != i
        out.append((r[0], len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "revisit" if revisit else "response", rows[first][0] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, least):
    rows = fixture()
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(5), least)
    found = got.collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute(rows, least)
    payload = {r.page_id: bytes(r.payload) for r in found if r.record_type == "response" and r.page_id is not None}
    assert payload[500] == rows[-1][2].encode()


def test_archives_are_members_with_offsets(spark, tmp_path):
    pages = spark.createDataFrame(fixture(), SCHEMA)
    warc.write(pages, f"{tmp_path}/raw")
    index = warc.normalise(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    whole = {p.name: gzip.decompress(p.read_bytes()) for p in (tmp_path / "raw").glob("*.gz")}
    for name, content in whole.items():
        out = (tmp_path / "out" / f"{name.split('.')[0]}.warc.gz").read_bytes()
        assert gzip.decompress(out) == content
    for r in index.collect():
        with open(r.path.removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            assert r.record_id.encode() in gzip.decompress(f.read(r.length))[:400]
    assert index.count() == len(fixture())


def test_broken_streams_are_errors():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n"
    good = gzip.compress(record * 3)
    sink = io.BytesIO()
    assert len(list(warc.rewrite(io.BytesIO(good + gzip.compress(record)), sink))) == 4
    for bad in (good[:-30], gzip.compress(record[:-7]), gzip.compress(record + b"WARC/1.1\r\nX"), gzip.compress(b"junk\r\n\r\n")):
        with pytest.raises((ValueError, KeyError)):
            list(warc.rewrite(io.BytesIO(bad), io.BytesIO()))


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
