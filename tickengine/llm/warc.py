"""WARC archives and their index, merged from sorted runs by loser trees.

``write_archives`` writes one record per capture. Spark's text writer does it: a record is
a line, and the ``\\r\\n\\r\\n`` that ends every record is the line separator. A capture whose
payload of ``least`` bytes or more was seen under a smaller id becomes a revisit of that id.
An archive holds captures whose payloads are of one class of size (each 16 times the one
below), so a number of records bounds its bytes, however sizes are mixed in the table.

``read_runs`` reads the archives back, file by file, with the lengths that the records
state. The index entries of a file, sorted by url key, timestamp, id and place, are a run.
``merge_runs`` cuts all runs at the same splitters and packs each piece into blocks; a
task gets the blocks of one key range, ordered by their first key, and merges the runs
with a loser tree. A run joins the tree when its first block is due, so a task holds at
most one block of each run that is open. Ranges are in order and merged inside, so range
and place in it order all captures: the histories of all urls.

Defined results: a NULL payload is empty; a NULL url is an empty key and sorts first; line
breaks in a url are percent-encoded in the header. NULL ids sort first and are never
referred to; repeated rows of the smallest id are all responses, and every row is a record.
An empty table gives no rows. Columns besides id, url, payload and time are not read.

Copies are found in a narrow table (id and digest); only digests that occur twice are
joined back: sent to all tasks if there are at most ``MOST_SENT`` of them, so that payloads
are not shuffled, else in a shuffle in which Spark splits the rows of a very common one. Splitters are a bounded number
of keys, taken from every run alike. Archives and blocks are in the shared folder.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickengine.session import new_dir

from .common import mapped, table, written

CRLF = "\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# Digests of copies that are sent to all tasks, about 100 bytes each.
MOST_SENT = 100_000


def _sized(captures: DataFrame) -> DataFrame:
    return captures.select(
        "id", "url", F.coalesce("payload", F.lit("")).alias("payload"), "time"
    ).withColumn("payload_bytes", F.octet_length("payload").cast("long"))


def _digested(captures: DataFrame) -> DataFrame:
    return captures.withColumn("payload_digest", F.sha2(F.col("payload").cast("binary"), 256))


def copied(captures: DataFrame, least: int) -> DataFrame:
    """``payload_digest`` and ``first_id`` of payloads that occur twice or more, in a table."""
    groups = (
        _digested(_sized(captures).filter(F.col("payload_bytes") >= least))
        .groupBy("payload_digest")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first_id").isNotNull())
        .select("payload_digest", "first_id")
    )
    found = written(groups, "warc-copies")
    return F.broadcast(found) if found.count() <= MOST_SENT else found


def mark_copies(captures: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds ``payload_digest``, ``record_type`` and ``refers_to`` to sized captures."""
    own = _digested(captures)
    again = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return own.join(groups, "payload_digest", "left").select(
        *[F.col(c) for c in own.columns],
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
    )


def _record_id(id_: Column, digest: Column) -> Column:
    """A name that follows from the capture, so that a task run again writes the same."""
    hexed = F.md5(F.concat_ws(":", id_.cast("string"), digest))
    return F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws("-", *[F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
        F.lit(">"),
    )


def records(marked: DataFrame) -> DataFrame:
    """Each capture as the text of one WARC record, without the separator behind it."""
    url = F.col("url")
    for char, code in (("\r", "%0D"), ("\n", "%0A")):
        url = F.replace(url, F.lit(char), F.lit(code))
    revisit = F.col("record_type") == "revisit"
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    block = F.concat(head, F.when(revisit, "").otherwise(F.col("payload")))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    return marked.select(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}"),
            field("WARC-Type", F.col("record_type")),
            field("WARC-Record-ID", _record_id(F.col("id"), F.col("payload_digest"))),
            field("WARC-Date", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
            field("WARC-Target-URI", url),
            field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
            field("X-Capture-Id", F.col("id").cast("string")),
            F.when(revisit, F.concat(
                field("WARC-Profile", F.lit(PROFILE)),
                field("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("payload_digest"))),
                field("X-Refers-To-Id", F.col("refers_to").cast("string")),
            )).otherwise(""),
            F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
            F.octet_length(block).cast("string"),
            F.lit(CRLF * 2),
            block,
        ).alias("value")
    )


# Payload bytes of the smallest class of size.
LEAST_CLASS = 1 << 14


def size_class(payload_bytes: Column) -> Column:
    """0 for up to ``LEAST_CLASS`` bytes, one more for each 16 times as many."""
    over = F.ceil(F.log2(F.greatest(payload_bytes, F.lit(1)) / F.lit(LEAST_CLASS)) / 4)
    return F.greatest(over, F.lit(0)).cast("int")


def write_archives(
    captures: DataFrame, path: str, archive_bytes: int = 64 << 20, least: int = 100
) -> None:
    """Gzipped archives of ``captures`` (id, url, payload, time) below ``path``.

    The payloads of an archive have at most ``archive_bytes``, or it holds one record. There
    is a pass over the captures for each class of size that occurs.
    """
    groups = copied(captures, least)
    own = _sized(captures).withColumn("class", size_class(F.col("payload_bytes")))
    classes = sorted(r["class"] for r in own.select("class").distinct().collect()) or [0]
    for number in classes:
        part = own.filter(F.col("class") == number).drop("class")
        (
            records(mark_copies(part, groups))
            .write.mode("error" if number == classes[0] else "append")
            .option("lineSep", CRLF * 2)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", max(1, archive_bytes // (LEAST_CLASS << (4 * number))))
            .text(path)
        )


class Bytes:
    """A gzipped archive read piece by piece."""

    def __init__(self, packed: bytes, piece: int = 1 << 18):
        self.packed, self.piece, self.at = memoryview(packed), piece, 0
        self.unpack = zlib.decompressobj(31)
        self.ready, self.place = bytearray(), 0

    def fill(self, n: int) -> bool:
        """At least ``n`` bytes ready, if the archive has them."""
        while len(self.ready) < n and self.at < len(self.packed):
            self.ready += self.unpack.decompress(self.packed[self.at : self.at + self.piece])
            self.at = min(len(self.packed), self.at + self.piece)
            if self.unpack.eof and self.unpack.unused_data:  # next member
                self.at -= len(self.unpack.unused_data)
                self.unpack = zlib.decompressobj(31)
        return len(self.ready) >= n

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError("an archive ends inside a record")
        found = bytes(self.ready[:n])
        del self.ready[:n]
        self.place += n
        return found

    def until(self, mark: bytes) -> bytes:
        """Up to and with ``mark``."""
        size = 1 << 10
        while True:
            more = self.fill(size)
            at = self.ready.find(mark)
            if at >= 0:
                return self.take(at + len(mark))
            if not more:
                raise ValueError("an archive ends inside a header")
            size *= 2


def read_records(packed: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, header, block)`` of each record, by the lengths they state."""
    data = Bytes(packed)
    while data.fill(1):
        offset = data.place
        version, *lines = data.until(END)[:-4].decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {offset}")
        header = dict(line.split(": ", 1) for line in lines)
        block = data.take(int(header["Content-Length"]))
        if data.take(4) != END:
            raise ValueError(f"the record at byte {offset} has another length")
        yield offset, data.place - offset, header, block


def url_key(url: str) -> str:
    """Host labels from the top down, then path and query in lower case."""
    if "://" not in url:
        return url.lower()
    host, slash, rest = url.partition("://")[2].partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")" + slash + rest.lower()


# An index entry: key fields first, so that entries sort as tuples of them.
ENTRY = [
    ("urlkey", "string"), ("time", "string"), ("id", "long"), ("file", "string"), ("offset", "long"),
    ("length", "long"), ("payload_bytes", "long"), ("payload_digest", "string"),
    ("record_type", "string"), ("refers_to", "long"),
]
KEYS = 5
_LEAST = -(1 << 63)
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
ENTRY_SCHEMA = ", ".join(f"{n} {t}" for n, t in ENTRY)


def entry(name: str, offset: int, length: int, header: dict[str, str], block: bytes) -> tuple:
    """The index entry of a record; a response's payload must have the stated digest."""
    http, _, payload = block.partition(END)
    stated = dict(line.split(": ", 1) for line in http.decode().split(CRLF)[1:])
    size, digest = int(stated["Content-Length"]), header["WARC-Payload-Digest"].partition(":")[2]
    kind = header["WARC-Type"]
    if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
        raise ValueError(f"{name}: the payload at byte {offset} is not the one written")
    own, other = header.get("X-Capture-Id"), header.get("X-Refers-To-Id")
    return (
        url_key(header.get("WARC-Target-URI", "")), header.get("WARC-Date", ""),
        _LEAST if own is None else int(own), name, offset, length, size, digest, kind,
        None if other is None else int(other),
    )


def _columns(rows: list[tuple], fields: list[tuple[str, str]]) -> list[pa.Array]:
    turned = list(zip(*rows)) or [[] for _ in fields]
    return [pa.array(list(c), _ARROW[t]) for c, (_, t) in zip(turned, fields)]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all archives below ``path``, with ``rank``, their place in the file's run."""
    fields = [*ENTRY, ("rank", "int")]
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    )

    def run(batches):
        for batch in batches:
            for name, content in zip(*batch.columns):
                name = name.as_py()
                made = [entry(name, *r) for r in read_records(content.as_buffer())]
                made.sort(key=lambda e: e[:KEYS])
                for at in range(0, len(made), 5_000):
                    part = [(*e, at + i) for i, e in enumerate(made[at : at + 5_000])]
                    yield pa.RecordBatch.from_arrays(_columns(part, fields), [n for n, _ in fields])

    return mapped(files, run, f"{ENTRY_SCHEMA}, rank int")


def splitters(runs: DataFrame, ranges: int, per_range: int = 32) -> list[tuple]:
    """``ranges`` - 1 keys that cut the entries evenly, from about ``per_range`` keys a range.

    Every run gives each ``step``-th of its keys, by a hash that also spreads short runs.
    """
    n = runs.count()
    if n == 0 or ranges < 2:
        return []
    step = max(1, n // (ranges * per_range))
    spread = F.pmod(F.col("rank") + F.pmod(F.xxhash64("file"), F.lit(step)), F.lit(step))
    keys = sorted(
        tuple(row) for row in
        runs.filter(spread == 0).select("urlkey", "time", "id", "file", "offset").collect()
    )
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


class LoserTree:
    """The least head of k sorted streams at a time; a replay asks log2 k comparisons.

    Streams are queues of entries that may be fed again after they ran dry.
    """

    def __init__(self, streams: list[deque]):
        self.streams = streams
        self.losers = [-1] * max(1, len(streams))
        self.winner = self._play(1) if streams else -1

    def _less(self, a: int, b: int) -> bool:
        x, y = self.streams[a], self.streams[b]
        if not x or not y:
            return bool(x)
        return x[0][:KEYS] < y[0][:KEYS]

    def _play(self, node: int) -> int:
        """The winner below ``node``; stream j is the leaf k + j."""
        k = len(self.streams)
        if node >= k:
            return node - k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = (b, a) if self._less(b, a) else (a, b)
        return winner

    def head(self) -> tuple | None:
        """The least entry; None when all streams are dry."""
        return self.streams[self.winner][0] if self.winner >= 0 and self.streams[self.winner] else None

    def pop(self) -> tuple:
        """Takes the least entry; its stream plays against the losers on its way up."""
        w = self.winner
        found = self.streams[w].popleft()
        node = (w + len(self.streams)) // 2
        while node >= 1:
            if self._less(self.losers[node], w):
                self.losers[node], w = w, self.losers[node]
            node //= 2
        self.winner = w
        return found


def merge_blocks(blocks: Iterable[tuple[str, list[tuple]]]) -> Iterator[tuple]:
    """One sorted stream from ``(run, block)`` ordered by first entry.

    Whatever is smaller than the next block's first entry leaves the tree before that
    block comes in, so what waits is at most about one block of each run.
    """
    runs: dict[str, deque] = {}
    tree = LoserTree([])
    for name, block in blocks:
        while (head := tree.head()) is not None and head[:KEYS] < block[0][:KEYS]:
            yield tree.pop()
        runs = {run: queue for run, queue in runs.items() if queue or run == name}
        runs.setdefault(name, deque()).extend(block)
        tree = LoserTree(list(runs.values()))
    while tree.head() is not None:
        yield tree.pop()


def merge_runs(runs: DataFrame, cuts: list[tuple], per_block: int = 512) -> DataFrame:
    """All entries with ``range`` and ``place``, which order them by key and timestamp."""
    names = [n for n, _ in ENTRY]

    def pack(batches):
        """A run's rows come in order, so a block is full or ends with its range or file."""
        held: list[tuple] = []
        key = None

        def block():
            first = held[0]
            row = [(key[0], key[1], *first[:3], first[4], json.dumps(held))]
            fields = [("range", "int"), ("run", "string"), *ENTRY[:3], ENTRY[4], ("packed", "string")]
            return pa.RecordBatch.from_arrays(_columns(row, fields), [n for n, _ in fields])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[: len(ENTRY)])):
                own = (bisect.bisect_right(cuts, row[:KEYS]), row[3])
                if held and (own != key or len(held) >= per_block):
                    yield block()
                    held = []
                if held and row[:KEYS] < held[-1][:KEYS]:
                    raise ValueError(f"the run of {row[3]} is not in order")
                key = own
                held.append(row)
        if held:
            yield block()

    schema = "range int, run string, urlkey string, time string, id long, offset long, packed string"
    packed = mapped(runs.select(*names), pack, schema)
    dealt = packed.repartitionByRange(len(cuts) + 1, "range").sortWithinPartitions(
        "range", "urlkey", "time", "id", "run", "offset"
    )
    fields = [*ENTRY, ("range", "int"), ("place", "int")]

    def merge(batches):
        def blocks():
            for batch in batches:
                for number, run, text in zip(*(c.to_pylist() for c in batch.columns)):
                    yield number, run, [tuple(e) for e in json.loads(text)]

        def ranges():
            source = blocks()
            ahead = next(source, None)
            while ahead:
                number = ahead[0]

                def own():
                    nonlocal ahead
                    while ahead and ahead[0] == number:
                        yield ahead[1:]
                        ahead = next(source, None)

                yield number, merge_blocks(own())

        for number, entries in ranges():
            made: list[tuple] = []
            for place, found in enumerate(entries):
                made.append((*found, number, place))
                if len(made) == 5_000:
                    yield pa.RecordBatch.from_arrays(_columns(made, fields), [n for n, _ in fields])
                    made = []
            if made:
                yield pa.RecordBatch.from_arrays(_columns(made, fields), [n for n, _ in fields])

    merged = mapped(dealt.select("range", "run", "packed"), merge, f"{ENTRY_SCHEMA}, range int, place int")
    return merged.withColumn("id", F.when(F.col("id") != _LEAST, F.col("id")))


def histories(
    spark: SparkSession, path: str, per_range: int = 5_000, max_ranges: int = 4_096
) -> DataFrame:
    """The merged index of the archives below ``path``; larger ranges beyond ``max_ranges``."""
    runs = written(read_runs(spark, path), "warc-runs")
    return merge_runs(runs, splitters(runs, min(max_ranges, -(-runs.count() // per_range))))


def query(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captures = pages.select(
        F.col("page_id").alias("id"),
        "url",
        F.coalesce("html", F.lit("")).alias("payload"),
        # The table has no time of capture: one a second, in the order of ids.
        F.timestamp_seconds(1_704_067_200 + F.col("page_id")).alias("time"),
    )
    path = new_dir(spark, "warc")
    write_archives(captures, path)
    return histories(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), first AS (
  SELECT *, MIN(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM first
"""
