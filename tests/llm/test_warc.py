import gzip
import hashlib
import io

import pytest

from ledgerline.llm import warc


def brute(pages):
    first = {}
    for p, _, html in pages:
        data = (html or "").encode()
        if p is not None and len(data) >= 100:
            first[data] = min(p, first.get(data, p))
    out = []
    for p, _, html in pages:
        data = (html or "").encode()
        to = first.get(data) if sum((h or "").encode() == data for _, _, h in pages) > 1 else None
        to = None if to == p else to
        out.append((p, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


PAGES = [
    (1, "http://a/", "x" * 100), (2, None, "x" * 100), (3, "http://b/\r\nX: y", "é" * 50), (0, "u", "é" * 50), (4, "u", "x" * 99),
    (5, "u", "x" * 99), (6, "u", None), (7, "u", ""), (8, "u", "a\r\n\r\nb" * 50), (8, "u", "a\r\n\r\nb" * 50), (None, "u", "x" * 100),
    (9, "u", "long " * 100_000), (10, "u", "WARC/1.1\r\n\r\n" * 20),
]


def test_round_trip(spark):
    frame = spark.createDataFrame([(*p, "d", 1) for p in PAGES], "page_id long, url string, html string, digest string, first int")
    assert sorted((tuple(r) for r in warc.round_trip(frame.repartition(3)).collect()), key=str) == brute(PAGES)


@pytest.mark.parametrize("most", [10_000, 3])
def test_archives_are_read_in_many_tasks(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(warc, "READ_TASKS", most)
    frame = spark.createDataFrame([(i, "u", f"{i} " * 60) for i in range(200)], "page_id long, url string, html string").repartition(12)
    # Small partitions stay apart, so that there are many archives.
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    archives = warc.write(frame, str(tmp_path / "w"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    n = archives.count()
    found = warc.read(archives)
    assert n > 3 and found.rdd.getNumPartitions() == min(n, most)
    used = found.select("page_id", warc.F.spark_partition_id().alias("p")).collect()
    assert len(used) == 200 and len({r.p for r in used}) == min(n, most)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize("size", [1, 7, 1 << 16])
def test_members_are_read_in_small_pieces(size):
    raw = [warc.record(i, "u", b"z" * i * 50) for i in range(5)]
    got = [warc.parsed(m) for m in warc.members(io.BytesIO(b"".join(raw)), size)]
    assert [p for _, _, p in got] == [b"z" * i * 50 for i in range(5)]
    assert [gzip.decompress(x)[:8] for x in raw] == [b"WARC/1.1"] * 5


def test_damage_is_found():
    raw = warc.record(1, "u", b"payload" * 30)
    with pytest.raises(warc.DamagedArchive):
        list(warc.members(io.BytesIO(raw[:-9])))
    plain = gzip.decompress(raw)
    for bad in (plain.replace(b"payload", b"pAyload", 1), plain[:-5], plain.replace(b"Content-Length: ", b"Content-Length: 1", 1)):
        with pytest.raises(warc.DamagedArchive):
            warc.parsed(bad)
