import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from regflow.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first long, body string"
FAKE = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ROWS = [
    (1, "http://a/", "same"), (2, "http://b/ x\r\ny", "same"), (0, None, "same"), (3, "u", ""), (4, "u", None), (5, "u", "é\n\r\n\r\n"),
    (6, "u", FAKE), (7, "u", "y" * 300_000), (8, "u", "WARC/1.1\r\n"), (9, "u", FAKE * 3), (3, "u", ""), (None, "u", "same"), (None, "u", "alone"), (10, "u", "\x00 "),
]


def brute(rows, least=0):
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        known = [x for x in groups[h or ""] if x is not None]
        first = min(known) if known and len(data) >= least else None
        revisit = first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "d", 1, "b") for r in ROWS], SCHEMA)


@pytest.mark.parametrize("least", [0, 3, 5])
def test_round_trip(spark, pages, tmp_path, least):
    path = f"file://{tmp_path}/w"
    warc.write_warc(pages.repartition(3), path, least=least)
    got = warc.page_records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS, least)


@pytest.mark.parametrize("size", [9_000, 70_000])
def test_ranges_lose_nothing(spark, pages, tmp_path, size):
    path = f"file://{tmp_path}/w"
    warc.write_warc(pages.coalesce(1), path)
    whole = warc.read_warc(spark, path).select("record_id", "payload").collect()
    parts = warc.read_warc(spark, path, range=str(size)).select("record_id", "payload").collect()
    assert len(parts) == len(ROWS)
    assert sorted(map(str, parts)) == sorted(map(str, whole))
    payloads = {r.record_id: r.payload for r in whole}
    assert bytes(payloads["<urn:page:9>"]).decode() == FAKE * 3


def test_predicates_and_payloads_are_pushed(spark, pages, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write_warc(pages, path)
    kept = warc.read_warc(spark, path, payload=False).filter("record_type = 'revisit' AND length < 500")
    assert "payload" not in kept.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not any("Filter " in line for line in plan.splitlines() if "BatchScan" not in line)
    assert kept.count() == sum(r[3] == "revisit" for r in brute(ROWS))
    one = warc.read_warc(spark, path).filter(F.col("record_id") == "<urn:page:5>").first()
    assert bytes(one.payload).decode() == "é\n\r\n\r\n" and one.digest_matches


def test_damage_is_an_error(spark, pages, tmp_path):
    path = tmp_path / "w"
    warc.write_warc(pages.coalesce(1), f"file://{path}")
    file = next(path.glob("part-*"))
    file.write_bytes(file.read_bytes().replace(b"alone", b"alonf"))
    (path / f".{file.name}.crc").unlink()
    with pytest.raises(Exception, match="damaged payload"):
        warc.page_records(spark, f"file://{path}").collect()


def test_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write_warc(spark.createDataFrame([], SCHEMA), path)
    assert warc.page_records(spark, path).count() == 0
