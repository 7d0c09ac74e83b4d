"""WARC archives: a deterministic sharded writer and its reader.

Pages are range-sorted by (id, payload digest, url) and dealt to shards of equal
numbers of records; each task writes one shard as gzip archives (a member per
record) that roll by compressed size. The cuts between shards are exact places in
the sorted order, found on ids and digests alone, so the same pages give the same
archives, byte for byte, however they were partitioned. A repeated or null id is
cut like any other; copies of one row may be cut too: every shard that has some of
them gets the row once and knows how many to write. Headers and digests are made
anew from the payload. An archive is written under a temporary name and renamed
when complete; the manifest, written last, names the archives that count, with
size and SHA-256, so a job that fails leaves nothing that a reader takes.

Of pages with equal payloads of at least ``min_revisit`` bytes the one with the
smallest id is a response, the others are revisits of it. Which pages revisit
which is found on ids and digests alone; these marks are sorted in before the
pages, so payloads are shuffled once and never by digest, and copies of a row in
one batch are shuffled as one.

Defined results: a null html is an empty payload; a null url writes no target;
a null page id sorts first, is written as such and never the one revisited; of
repeated rows (same id and payload) the first is the response; an empty table
gives an empty manifest and no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import open_fs, shuffle_count, stored, text_batches, text_or_empty, write_file
from tidemark.session import scratch_path

ROLL_BYTES = 256 << 20
READ_BYTES = 1 << 20
OUT_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
MANIFEST = "part long, piece long, path string, records long, revisits long, n_bytes long, sha256 string"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def digests(pages: DataFrame) -> DataFrame:
    """(page_id, digest, url_digest, payload_bytes) of every page, stored."""
    payload = F.encode(text_or_empty("html"), "UTF-8")
    return stored(pages.select(F.col("page_id").cast("long").alias("page_id"), F.unhex(F.sha2(payload, 256)).alias("digest"),
                               url_digest().alias("url_digest"), F.octet_length(payload).alias("payload_bytes")), "op9-digests", "snappy")


def url_digest() -> Column:
    url = F.col("url").cast("string")
    return F.unhex(F.sha2(F.encode(F.when(url.isNull(), "-").otherwise(F.concat(F.lit("+"), url)), "UTF-8"), 256))


def revisit_marks(rows: DataFrame, min_revisit: int = 100) -> DataFrame:
    """(page_id, digest, refers_to) of every page whose payload occurs more than once."""
    rows = rows.where(F.col("payload_bytes") >= min_revisit)
    groups = stored(rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1 and refers_to is not null").select("digest", "refers_to"), "op9-groups", "snappy")
    return stored(rows.join(groups.hint("merge"), "digest").select("page_id", "digest", "refers_to").distinct(), "op9-marks", "snappy")


@dataclass(frozen=True)
class Cuts:
    """Where shards begin (shard 0 at the start): the row's key, how many copies of it
    stand before the cut, and how many rows of its (id, digest)."""
    keys: list[tuple]
    copies: list[int]
    rows: list[int]

    @staticmethod
    def key(page_id: int | None, digest: bytes, url_digest: bytes) -> tuple:
        return page_id is not None, page_id or 0, digest, url_digest

    def shards(self, key: tuple) -> range:
        """The shards that write copies of a row."""
        a, b = bisect_left(self.keys, key), bisect_right(self.keys, key)
        return range(a + (a < b and self.copies[a] == 0), b + 1)

    def marked(self, page_id: int | None, digest: bytes) -> range:
        """The shards that write rows of an (id, digest)."""
        return range(bisect_left(self.keys, self.key(page_id, digest, b"")), bisect_left(self.keys, self.key(page_id, digest, b"\xff" * 33)) + 1)

    def span(self, shard: int, key: tuple, n: int) -> tuple[int, int]:
        """First and last (exclusive) of the ``n`` copies of a row that a shard writes."""
        first = self.copies[shard - 1] if shard and self.keys[shard - 1] == key else 0
        return first, self.copies[shard] if shard < len(self.keys) and self.keys[shard] == key else n

    def before(self, shard: int, key: tuple) -> int:
        """Rows of the key's (id, digest) that earlier shards write."""
        return self.rows[shard - 1] if shard and self.keys[shard - 1][:3] == key[:3] else 0


def exact_cuts(rows: DataFrame, ranges: int) -> Cuts:
    """Cuts of the rows, sorted by (page_id null first, digest, url_digest), into ``ranges`` shards of equal numbers; ``ranges - 1`` rows reach the driver."""
    spark, names = rows.sparkSession, ["page_id", "digest", "url_digest"]
    order = [F.col("page_id").asc_nulls_first(), "digest", "url_digest"]
    counts = stored(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "op9-counts", "snappy")
    dealt = stored(counts.repartitionByRange(shuffle_count(spark), *order).sortWithinPartitions(*order)
                   .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "op9-order", "snappy")
    parts = stored(dealt.groupBy("part").agg(F.sum("n").alias("own")), "op9-parts", "snappy")          # a row for each task
    ahead = parts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("ahead"))
    total = parts.agg(F.sum("own")).first()[0]
    if not total:
        return Cuts([], [], [])
    own = Window.partitionBy("part").orderBy("at")
    placed = stored(dealt.join(ahead, "part").select(*names, "n", (F.col("ahead") + F.sum("n").over(own) - F.col("n")).alias("first")), "op9-placed", "snappy")
    # the first cut at or after a place
    up = lambda place: F.expr(f"(({place}) * {ranges}L + {total - 1}L) div {total}L")
    low, high = F.greatest(up("first"), F.lit(1)), F.least(up("first + n") - 1, F.lit(ranges - 1))
    cut = placed.where(low <= high).select("*", F.explode(F.sequence(low, high)).alias("cut"))
    group = cut.select(F.col("page_id").alias("g_id"), F.col("digest").alias("g_digest")).distinct()
    starts = (placed.join(F.broadcast(group), F.col("page_id").eqNullSafe(F.col("g_id")) & (F.col("digest") == F.col("g_digest")))   # at most ``ranges`` groups
              .groupBy("g_id", "g_digest").agg(F.min("first").alias("start")))
    found = sorted((r["cut"], Cuts.key(r["page_id"], bytes(r["digest"]), bytes(r["url_digest"])), r["cut"] * total // ranges - r["first"], r["cut"] * total // ranges - r["start"])
                   for r in cut.join(F.broadcast(starts), F.col("page_id").eqNullSafe(F.col("g_id")) & (F.col("digest") == F.col("g_digest"))).collect())
    return Cuts(*(list(c) for c in list(zip(*found))[1:])) if found else Cuts([], [], [])


def header_value(value: str) -> str:
    """One line: control characters percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as a gzip member (no time stamp in it)."""
    lines = [*headers, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def record(page_id: int | None, nth: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, level: int) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}:{digest}:{nth}>"), ("WARC-Date", DATE),
               ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        headers.insert(2, ("WARC-Target-URI", header_value(url)))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}:{digest}:0>"), ("WARC-Profile", REVISIT_PROFILE)]
    return member(headers, HTTP_HEAD.format(len(payload)).encode() + (payload if refers_to is None else b""), level)


DEALT = "shard int, page_id long, digest binary, kind int, url_digest binary, copies long, url string, payload binary, refers_to long"


def write_warc(pages: DataFrame, out: str, min_revisit: int = 100, roll_bytes: int = ROLL_BYTES, ranges: int | None = None, level: int = 6) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``out``, in ``ranges``
    shards (default: the session's shuffle partitions); returns the manifest."""
    spark = pages.sparkSession
    light = digests(pages)
    cuts = exact_cuts(light, ranges or shuffle_count(spark))
    names = [f.split()[0] for f in DEALT.split(", ")]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.binary(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches([whole], column="payload"):
                seen: dict[tuple, list] = {}               # rows of one bounded batch
                for page_id, url, payload, digest, own in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "url_digest"))):
                    seen.setdefault(Cuts.key(page_id, digest, own), [page_id, url, payload, 0])[3] += 1
                rows = [(shard, page_id, key[2], 1, key[3], n, url, payload, None) for key, (page_id, url, payload, n) in seen.items() for shard in cuts.shards(key)]
                if rows:
                    yield batch_of(rows)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(shard, page_id, digest, 0, b"", 0, None, None, refers_to)
                    for page_id, digest, refers_to in zip(*(batch[c].to_pylist() for c in ("page_id", "digest", "refers_to"))) for shard in cuts.marked(page_id, digest)]
            if rows:
                yield batch_of(rows)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), str(task.taskAttemptId())
        source = members(batches)
        item, piece = next(source, None), 0
        while item is not None:
            box, sha, seen = [item], hashlib.sha256(), [0, 0]

            def body() -> Iterator[bytes]:
                size = 0
                info = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{part}:{piece}>"), ("WARC-Date", DATE),
                               ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", level)
                sha.update(info)
                yield info
                while box[0] is not None and size < roll_bytes:
                    data, revisit = box[0]
                    sha.update(data)
                    size += len(data)
                    seen[0] += 1
                    seen[1] += revisit
                    yield data
                    box[0] = next(source, None)

            path = f"{out}/pages-{part:06d}-{piece:04d}.warc.gz"
            n_bytes = write_file(path, attempt, body())
            yield pa.RecordBatch.from_pydict({"part": [part], "piece": [piece], "path": [path], "records": [seen[0]], "revisits": [seen[1]],
                                              "n_bytes": [n_bytes], "sha256": [sha.hexdigest()]})
            item, piece = box[0], piece + 1

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bool]]:
        """Records of the sorted rows: the mark of an (id, digest) first, then its rows, copies summed; one row is held at a time."""
        group, target, nth, held = None, None, 0, None

        def copies(shard: int, key: tuple, page_id: int | None, url: str | None, payload: bytes, n: int) -> Iterator[tuple[bytes, bool]]:
            nonlocal nth
            first, last = cuts.span(shard, key, n)
            digest = hashlib.sha256(payload).hexdigest()
            for _ in range(first, last):
                refers_to = None if target == page_id and nth == 0 else target
                yield record(page_id, nth, url, payload, digest, refers_to, level), refers_to is not None
                nth += 1

        for batch in batches:
            columns = (batch[c].to_pylist() for c in names)
            for shard, page_id, digest, kind, own, n, url, payload, refers_to in zip(*columns):
                key = Cuts.key(page_id, digest, own)
                if held is not None and held[1] != key:
                    yield from copies(*held)
                    held = None
                if key[:3] != group:
                    group, target, nth = key[:3], None, cuts.before(shard, key)
                if kind == 0:
                    target = refers_to
                elif held is None:
                    held = [shard, key, page_id, url, payload, n]
                else:
                    held[5] += n
        if held is not None:
            yield from copies(*held)

    payload = F.encode(text_or_empty("html"), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        F.unhex(F.sha2(payload, 256)).alias("digest"), url_digest().alias("url_digest"))
    (rows.mapInArrow(deal, DEALT).unionByName(revisit_marks(light, min_revisit).mapInArrow(mark, DEALT))
     .repartitionById(len(cuts.keys) + 1, F.col("shard"))
     .sortWithinPartitions(F.col("page_id").asc_nulls_first(), "digest", "kind", "url_digest")
     .mapInArrow(write, MANIFEST).write.parquet(f"{out}/_manifest"))
    return spark.read.parquet(f"{out}/_manifest")


def parse_members(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of one archive; one record is held at a time."""
    fs, bare = open_fs(path)
    with fs.open_input_stream(bare, compression=None) as f:
        data = f.read(READ_BYTES)
        while data:
            unpack, parts = zlib.decompressobj(31), []
            while not unpack.eof:
                if not data:
                    raise ValueError(f"{path} ends inside a record")
                parts.append(unpack.decompress(data))
                data = unpack.unused_data if unpack.eof else f.read(READ_BYTES)
            data = data or f.read(READ_BYTES)
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines)
            block = rest[:int(headers["Content-Length"])]
            if version != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                raise ValueError(f"{path} has a damaged record: {headers.get('WARC-Record-ID')}")
            yield headers, block


def page_of(urn: str | None) -> int | None:
    """Page id of ``<urn:page:ID:DIGEST:N>``."""
    if urn is None:
        return None
    value = urn.split(":")[2]
    return None if value == "None" else int(value)


def read_warc(spark: SparkSession, out: str) -> DataFrame:
    """Records of the archives that the manifest under ``out`` names.

    A revisit's payload is null; its length and digest come from its headers.
    """
    manifest = spark.read.parquet(f"{out}/_manifest")
    files = manifest.select("path", "records", (F.row_number().over(Window.orderBy("part", "piece")) - 1).cast("int").alias("file"))   # a row per file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, expected in zip(batch["path"].to_pylist(), batch["records"].to_pylist()):
                rows, size, n = [], 0, 0
                for headers, block in parse_members(path):
                    kind = headers["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    if kind == "response":
                        length, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    else:
                        length = int(http.decode().rsplit("Content-Length: ", 1)[1])
                        digest, payload = headers["WARC-Payload-Digest"].removeprefix("sha256:"), None
                    rows.append((page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind, page_of(headers.get("WARC-Refers-To")), length, digest, payload))
                    size, n = size + len(block), n + 1
                    if size > OUT_BYTES:
                        yield to_batch(rows)
                        rows, size = [], 0
                if n != expected:
                    raise ValueError(f"{path} has {n} records, the manifest says {expected}")
                if rows:
                    yield to_batch(rows)

    return files.repartitionById(max(1, manifest.count()), F.col("file")).mapInArrow(read, RECORDS)


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                      ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])


def write_and_read(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """Write ``pages`` to a fresh folder of the shared scratch space and read the archives back."""
    out = scratch_path(pages.sparkSession, "op9-archives")
    write_warc(pages, out, min_revisit)
    return read_warc(pages.sparkSession, out)
