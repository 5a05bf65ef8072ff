"""WARC archives with a two-level capture index.

Each task writes its pages as one archive, every record a gzip member of its own, and returns where the records lie. The
captures are sorted by reversed-host key into index shards: compressed blocks of lines, with a sparse directory (the first
key of each block) at the end of the shard. A lookup is a binary search in the list of shards, another in the directory,
one range read of a block, and one range read of the record; sorted lookups share blocks, and captures are read in archive
order, neighbours in one range.

Files go to the folder that driver and executors share, under names of the task that wrote them; only files named by rows
that were kept are ever read, so a repeated or lost task leaves nothing wrong. The driver sees a row for each index shard.

Defined results: null html is an empty payload; null url gets a key of its own; rows without page_id are responses and nothing
refers to them; rows that share a page_id are records each. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capsieve.llm.store import new_path, written

LEAST_PAYLOAD = 100  # bytes from which equal payloads are stored once
BLOCK_LINES = 1000
RANGE_BYTES, GAP_BYTES = 4 << 20, 64 << 10
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
LEVEL = 6
_END = b"\r\n"


def _open(uri: str, write: bool = False):
    store, path = fs.FileSystem.from_uri(uri)
    if write:
        store.create_dir(path.rpartition("/")[0], recursive=True)
        return store.open_output_stream(path, compression=None)
    return store.open_input_file(path)


def record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """A response record, or, where `first` names the page with the same payload, a revisit record without the payload."""
    name = "unknown" if page is None else str(page)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first is not None else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or f"urn:page:{name}")
    fields = ["WARC/1.0", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
              f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if first is not None:
        fields += [f"WARC-Refers-To: <urn:page:{first}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    fields.append(f"Content-Length: {len(block)}")
    return _END.join(f.encode() for f in fields) + _END * 2 + block + _END * 2


def parsed(raw: bytes) -> dict:
    """Of one record: page_id, url, payload_bytes, payload_digest, record_type, refers_to. The digest of a stored payload is computed anew."""
    head, _, rest = raw.partition(_END * 2)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(_END * 2)
    name = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
    revisit = fields["WARC-Type"] == "revisit"
    size = int(next(line.split(b": ")[1] for line in http.split(_END) if line.startswith(b"Content-Length")))
    return {"page_id": None if name == "unknown" else int(name), "url": fields["WARC-Target-URI"], "payload_bytes": size if revisit else len(payload),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest(),
            "record_type": fields["WARC-Type"], "refers_to": int(fields["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">")) if revisit else None}


def capture_key(url: Column, page: Column) -> Column:
    """Reversed host, rest of the address, then the page: `net,example,www)/path 00000000000000000007`, in one line."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    address = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), F.lit(")"), rest)
    line = F.regexp_replace(F.coalesce(address, F.lit("")), r"[\x00-\x20]", "_")
    return F.concat(line, F.lit(" "), F.coalesce(F.lpad(page.cast("string"), 20, "0"), F.lit("-")))


def _archived(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, out, at = f"{folder}/archives/{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                keys, starts, lengths = batch.column("key"), [], []
                for page, url, html, digest, first in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "first")), strict=True):
                    member = gzip.compress(record(page.as_py(), url.as_py(), (html.as_py() or "").encode(), digest.as_py(), first.as_py()), LEVEL, mtime=0)
                    out = out or _open(file, write=True)
                    out.write(member)
                    starts.append(at)
                    lengths.append(len(member))
                    at += len(member)
                yield pa.RecordBatch.from_arrays([keys, pa.array([file] * len(keys), pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                                                 ["key", "file", "offset", "length"])
        finally:
            if out:
                out.close()
    return run


def _indexed(folder: str):
    """Sorted captures of a task -> one shard: blocks, directory, and the directory's size in the last eight bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, out, at, lines, directory = f"{folder}/index/{uuid.uuid4().hex}.cdx", None, 0, [], []

        def close_block() -> None:
            nonlocal at, out
            body = zlib.compress("\n".join(lines).encode(), LEVEL)
            out = out or _open(file, write=True)
            out.write(body)
            directory.append((lines[0].split("\t")[0], at, len(body)))
            at += len(body)
            lines.clear()

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "offset", "length")), strict=True):
                lines.append("\t".join(map(str, row)))
                if len(lines) >= BLOCK_LINES:
                    close_block()
        if lines:
            close_block()
        if out:
            tail = zlib.compress(json.dumps(directory).encode(), LEVEL)
            out.write(tail + len(tail).to_bytes(8, "big"))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([file])], ["first", "file"])
    return run


def _looked_up(shards: list[tuple[str, str]]):
    """Sorted keys -> their captures. A shard and a block stay open while the keys stay in them."""
    firsts = [first for first, _ in shards]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple = (None, None, None, None)
        block_at, block = None, {}
        for batch in batches:
            found = []
            for key in batch.column("key").to_pylist():
                # equal keys may lie across a border: begin one before the first shard and block that start at the key
                for number in range(max(0, bisect.bisect_left(firsts, key) - 1), bisect.bisect_right(firsts, key)):
                    if opened[0] != number:
                        file = _open(shards[number][1])
                        size = file.size()
                        tail = int.from_bytes(file.read_at(8, size - 8), "big")
                        directory = json.loads(zlib.decompress(file.read_at(tail, size - 8 - tail)))
                        opened, block_at = (number, file, directory, [d[0] for d in directory]), None
                    _, file, directory, keys = opened
                    for place in range(max(0, bisect.bisect_left(keys, key) - 1), bisect.bisect_right(keys, key)):
                        if block_at != (number, place):
                            _, start, length = directory[place]
                            block_at, block = (number, place), {}
                            for line in zlib.decompress(file.read_at(length, start)).decode().split("\n"):
                                name, *where = line.split("\t")
                                block.setdefault(name, []).append(where)
                        found += [(key, f, int(o), int(n)) for f, o, n in block.get(key, [])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             ["key", "file", "offset", "length"])
    return run


_FIELDS = (("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
           ("record_type", pa.string()), ("refers_to", pa.int64()))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Captures in archive order -> their records, neighbours in one range read."""
    name, file = None, None
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
        out, i = [], 0
        while i < len(rows):
            j, end = i, rows[i][1] + rows[i][2]
            while j + 1 < len(rows) and rows[j + 1][0] == rows[i][0] and rows[j + 1][1] - end <= GAP_BYTES and rows[j + 1][1] + rows[j + 1][2] - rows[i][1] <= RANGE_BYTES:
                j += 1
                end = max(end, rows[j][1] + rows[j][2])
            if name != rows[i][0]:
                name, file = rows[i][0], _open(rows[i][0])
            body = file.read_at(end - rows[i][1], rows[i][1])
            out += [parsed(gzip.decompress(body[o - rows[i][1] : o - rows[i][1] + n])) for _, o, n in rows[i : j + 1]]
            i = j + 1
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in _FIELDS], [c for c, _ in _FIELDS])


def write_archives(pages: DataFrame) -> list[tuple[str, str]]:
    """Writes archives and index of pages (page_id, url, html); returns the shards of the index: first key and file of each."""
    spark, folder = pages.sparkSession, new_path(pages.sparkSession, "warc")
    page, html = F.col("page_id").cast("long"), F.coalesce("html", F.lit(""))
    rows = pages.select(page.alias("page_id"), F.col("url"), html.alias("html"), F.sha2(html, 256).alias("digest"), capture_key(F.col("url"), page).alias("key"))
    digests = written(rows.select("page_id", "digest", F.octet_length("html").alias("size")).where(F.col("size") >= LEAST_PAYLOAD), "digests")
    several = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first != last").drop("last")
    several = written(several, "several")
    revisits = written(digests.join(several, "digest").where("page_id != first").select("page_id", "digest", "first").distinct(), "revisits")
    schema = "key string, file string, offset long, length long"
    captures = written(rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "first", "key")
                       .mapInArrow(_archived(folder), schema), "captures")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = written(captures.repartitionByRange(shards, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
                    .mapInArrow(_indexed(folder), "first string, file string"), "shards")
    return sorted((r["first"], r["file"]) for r in index.toPandas().to_dict("records"))  # a row for each shard


def lookup(keys: DataFrame, shards: list[tuple[str, str]]) -> DataFrame:
    """keys (key) -> captures (key, file, offset, length)."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (keys.select("key").distinct().repartitionByRange(parts, "key").sortWithinPartitions("key")
            .mapInArrow(_looked_up(shards), "key string, file string, offset long, length long"))


def read(captures: DataFrame) -> DataFrame:
    """captures -> (page_id, url, payload_bytes, payload_digest, record_type, refers_to)."""
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (captures.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
            .mapInArrow(_read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages to archives, and each page's record back through the index."""
    shards = write_archives(pages)
    keys = pages.select(capture_key(F.col("url"), F.col("page_id").cast("long")).alias("key"))
    captures = written(lookup(keys, shards), "captures")
    return read(captures).drop("url")
