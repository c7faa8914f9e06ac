"""Archives read back equal what was written; the merge against plain sorting."""

import gzip
import hashlib
import heapq
import random

import pytest
from pyspark.sql import functions as F

from tickengine.llm import warc
from tickengine.session import new_dir


def histories(spark, rows, **sizes):
    frame = spark.createDataFrame(
        [(*r, "z") for r in rows], "id long, url string, payload string, time timestamp, record_type string"
    )
    path = new_dir(spark, "warc-test")
    warc.write_archives(frame.repartition(3), path, archive_bytes=4 * warc.LEAST_CLASS)
    return warc.histories(spark, path, **sizes).collect()


def test_edge_rows(spark):
    import datetime as dt

    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    big, hostile = "é" * 200_000, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9
    rows = [
        (5, "http://b.a/x", hostile, at), (3, "http://b.a/x", hostile, at), (3, "http://b.a/x", hostile, at),
        (1, None, None, None), (2, "a\r\nb: c", "", at), (4, "http://a/", big, at), (None, "http://a/", big, at),
        (None, "u", "x" * 150, at), (None, "u", "x" * 150, at), (7, "http://s/", "y" * 99, at), (8, "http://s/", "y" * 99, at),
    ]
    found = histories(spark, rows, per_range=3)
    assert len(found) == len(rows)
    expected = []
    for id_, _, payload, _ in rows:
        data = (payload or "").encode()
        same = [r[0] for r in rows if r[2] == payload and r[0] is not None]
        first = min(same) if len(data) >= 100 and same else id_
        expected.append((id_, len(data), hashlib.sha256(data).hexdigest(),
                         "response" if first == id_ else "revisit", None if first == id_ else first))
    got = [tuple(r[c] for c in ("id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    ordered = sorted(found, key=lambda r: (r["range"], r["place"]))
    keys = [(r["urlkey"], r["time"], -1 if r["id"] is None else r["id"]) for r in ordered]
    assert keys == sorted(keys)
    assert len({(r["range"], r["place"]) for r in found}) == len(rows)


def test_empty_table(spark):
    assert histories(spark, []) == []


def test_offsets_find_the_records(spark, sf_dir):
    path = new_dir(spark, "warc-test")
    rows = spark.createDataFrame([(i, f"http://a/{i}", "p" * i) for i in range(20)], "id long, url string, payload string")
    warc.write_archives(rows.withColumn("time", F.current_timestamp()).coalesce(1), path)
    packed = {r["name"]: bytes(r["content"]) for r in
              spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
              .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").collect()}
    for entry in warc.read_runs(spark, path).collect():
        record = gzip.decompress(packed[entry["file"]])[entry["offset"] : entry["offset"] + entry["length"]]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"p" * entry["id"] + b"\r\n\r\n")


def archives(spark, path):
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return [list(warc.read_records(bytes(r["content"]))) for r in found.collect()]


def test_archives_are_bounded_by_bytes(spark):
    """Pages of 2 MB, some of 40 kB and many small ones in one table of one partition."""
    sizes = [2_000_000] * 60 + [40_000] * 300 + [50] * 3_000
    rows = spark.range(len(sizes)).coalesce(1).select(
        "id", F.concat(F.lit("http://a/"), F.col("id").cast("string")).alias("url"),
        F.expr(f"rpad(concat(id, ' '), CASE WHEN id < 60 THEN {sizes[0]} WHEN id < 360 THEN 40000 ELSE 50 END, 'xyz ')")
        .alias("payload"), F.current_timestamp().alias("time"),
    )
    path = new_dir(spark, "warc-test")
    warc.write_archives(rows, path, archive_bytes=8 << 20)
    held = archives(spark, path)
    assert sum(map(len, held)) == len(sizes)
    assert all(sum(len(r[3]) for r in records) <= (8 << 20) + 500 * len(records) for records in held)
    assert len(held) <= 30 + 15 + 10  # two large pages, 32 middle ones or 512 small ones in each
    found = warc.histories(spark, path, per_range=500).collect()
    assert sorted((r["id"], r["payload_bytes"]) for r in found) == list(enumerate(sizes))


def test_size_classes(spark):
    base = warc.LEAST_CLASS
    sizes = [0, 1, base, base + 1, 16 * base, 16 * base + 1, 256 * base, 256 * base + 1, (1 << 31) - 1]
    rows = spark.createDataFrame([(n,) for n in sizes], "n long").select(warc.size_class(F.col("n")).alias("c"))
    assert [r["c"] for r in rows.collect()] == [0, 0, 0, 1, 1, 2, 2, 3, 5]


def test_copies_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(warc, "MOST_SENT", 0)
    rows = [(i, "u", "p" * (100 + i % 3), None) for i in range(9)]
    found = histories(spark, rows)
    assert sorted((r["id"], r["refers_to"]) for r in found) == [(i, i % 3 if i > 2 else None) for i in range(9)]


def test_damage_is_noticed():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    assert [b for *_, b in warc.read_records(gzip.compress(record * 3))] == [b"abcde"] * 3
    members = gzip.compress(record) + gzip.compress(record)
    assert len(list(warc.read_records(members))) == 2
    for broken in (record[:-3], record.replace(b"5", b"4"), b"nothing here\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.read_records(gzip.compress(broken)))


@pytest.mark.parametrize("k, seed", [(0, 1), (1, 2), (2, 3), (3, 4), (7, 5), (16, 6)])
def test_loser_tree_merges(k, seed):
    pick = random.Random(seed)
    runs = [sorted(((str(pick.randrange(9)), "", pick.randrange(9), f"r{i}", j) for j in range(pick.randrange(30))))
            for i in range(k)]
    blocks = sorted(
        ((run[at : at + 4][0], f"r{i}", run[at : at + 4]) for i, run in enumerate(runs) for at in range(0, len(run), 4)),
        key=lambda b: b[0],
    )
    merged = list(warc.merge_blocks((name, block) for _, name, block in blocks))
    assert merged == list(heapq.merge(*runs))


def test_query(spark, sf_dir, rows_of):
    found = {r["page_id"]: r for r in warc.query(spark, sf_dir).collect()}
    pages = [(p, (h or "").encode()) for p, h in rows_of("pages", "page_id, html")]
    first = {}
    for page, data in sorted(pages):
        first.setdefault(data, page)
    assert len(found) == len(pages)
    for page, data in pages:
        row, of = found[page], first[data] if len(data) >= 100 else page
        assert (row["payload_bytes"], row["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert (row["record_type"], row["refers_to"]) == (("response", None) if of == page else ("revisit", of))
