"""WARC archives with a two-level capture index.

Records are written in the order of their reversed-host keys, so the archive files and their
index agree in order. The index has two levels: lines of `key page_id file offset length`,
sorted, in compressed blocks of a fixed number of lines; and a directory with one entry per
block, its first key and where it lies. A look-up binary-searches the directory, reads one
range of the index, and then one range of the archive.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonal.llm.common import Finished, look_up, ship, store_of
from zonal.operators.staging import stage

# Lines per index block.
BLOCK_LINES = 1_000

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def surt(url: Column) -> Column:
    """Reversed-host key: `com,example,www)/path?query` in lower case up to the path. Anything
    that is not a URL is its own key."""
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)"
    host = F.lower(F.regexp_extract(url, parts, 1))
    turned = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    rest = F.regexp_extract(url, parts, 2)
    key = F.concat(turned, F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))
    return F.coalesce(F.when(host == "", url).otherwise(key), F.lit(""))


def base32_digest(sha1_hex: str) -> str:
    """Upper-case base32 of a SHA-1 in hex."""
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def first_of_equal(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Add `digest` (SHA-1, hex) and `refers_to`: the smallest page_id with the same payload for
    pages other than that one, NULL for the first itself and for payloads below `least_bytes`."""
    rows = pages.withColumn("payload_sha1", F.sha1(F.col("payload")))
    narrow = stage(rows.select("page_id", "payload_sha1", F.length("payload").alias("size")))
    known = narrow.where(F.col("size") >= F.lit(least_bytes)).groupBy("payload_sha1")
    firsts = known.agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # payloads that occur once need no look-up; of the others none holds more rows than it says
    firsts = stage(firsts)
    total = narrow.count()
    return look_up(rows, firsts.select("payload_sha1", "first_id", "n"), "payload_sha1", total)


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, parts: int | None = None) -> dict:
    """Write `page_id`, `url`, `html` as WARC records below `folder`, with their index; returns the
    manifest, also written as `manifest.json`: per part its first key and number of records.

    Of records with equal payloads of at least `least_bytes`, the one with the smallest page_id is
    a response and the others are revisits that point to it. NULL html: an empty payload. NULL
    url: an empty target, sorted first. NULL page_id: never the first while another id has the
    payload. Rows that repeat the first's id are responses like it. Empty table: no parts. Other
    columns are not read."""
    spark = pages.sparkSession
    ship(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    )
    marked = first_of_equal(rows, least_bytes)
    later = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    marked = marked.select(
        surt(F.col("url")).alias("key"),
        "page_id",
        "url",
        "payload_sha1",
        F.length("payload").cast("bigint").alias("size"),
        later.alias("revisit"),
        F.when(later, F.col("first_id")).alias("refers_to"),
        F.when(~later, F.col("payload")).alias("payload"),
    )
    order = ["key", "page_id", "payload_sha1"]
    ordered = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        store, path = store_of(folder)
        part, archive, index = TaskContext.get().partitionId(), None, None
        lines, directory, records, first_key = [], [], 0, ""

        def close_block():
            packed = zlib.compress("\n".join(lines).encode(), 6)
            directory.append([json.loads(lines[0])[0], index.size, len(packed), len(lines)])
            index.write(packed)
            lines.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            if archive is None:
                archive = Finished(store, f"{path}/part-{part:05d}.warc.gz")
                index = Finished(store, f"{path}/part-{part:05d}.idx")
                first_key = batch.column(0)[0].as_py()
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                key, page, record = row[0], row[1], warc_record(*row[1:])
                lines.append(json.dumps([key, page, archive.size, len(record)]))
                archive.write(record)
                records += 1
                if len(lines) == BLOCK_LINES:
                    close_block()
        if archive is None:
            return
        if lines:
            close_block()
        archive.close()
        index.close()
        side = Finished(store, f"{path}/part-{part:05d}.dir")
        side.write(json.dumps(directory).encode())
        side.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "first_key": [first_key], "records": [records]})

    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    written = ordered.mapInArrow(write, "part bigint, first_key string, records bigint")
    manifest = {"parts": [row.asDict() for row in sorted(written.collect())]}  # one row per file
    out = Finished(store, f"{path}/manifest.json")
    out.write(json.dumps(manifest).encode())
    out.close()
    return manifest


def _line(text: str) -> str:
    """A header value: line ends would end the header, so they are escaped, as are backslashes."""
    return text.replace("\\", "\\\\").replace("\r", "\\r").replace("\n", "\\n")


def _unline(value: str) -> str:
    """The text of a header value."""
    return re.sub(r"\\(.)", lambda m: {"r": "\r", "n": "\n"}.get(m[1], m[1]), value)


def warc_record(page, url, sha1, size, revisit, refers_to, payload) -> bytes:
    """One gzip member holding one record."""
    digest = f"sha1:{base32_digest(sha1)}"
    name = "" if page is None else str(page)
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: {digest}",
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        block = http
    else:
        block = http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 6, mtime=0)


def parse_record(packed: bytes) -> dict:
    """Headers and payload of one gzip member; checks that the payload is the one it says."""
    raw = gzip.decompress(packed)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a record: {version!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    http_fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    page = fields["WARC-Record-ID"][10:-1]
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of page {page} does not match its digest")
    return {
        "page_id": int(page) if page else None,
        "url": _unline(fields["WARC-Target-URI"]),
        "payload_bytes": int(http_fields["Content-Length"]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(fields["WARC-Refers-To"][10:-1]) if revisit else None,
        "payload": None if revisit else payload,
    }


def read_manifest(folder: str) -> dict:
    """The manifest of an archive folder."""
    store, path = store_of(folder)
    with store.open_input_stream(f"{path}/manifest.json") as stream:
        return json.loads(stream.read())


class Archive:
    """One part, read by ranges."""

    def __init__(self, folder: str, part: int):
        store, path = store_of(folder)
        name = f"{path}/part-{part:05d}"
        with store.open_input_stream(f"{name}.dir") as stream:
            self.directory = json.loads(stream.read())
        self.first_keys = [entry[0] for entry in self.directory]
        self.index, self.archive = store.open_input_file(f"{name}.idx"), store.open_input_file(f"{name}.warc.gz")

    def block(self, k: int) -> list:
        """Index lines of a block: key, page_id, offset, length."""
        _, at, length, _ = self.directory[k]
        packed = self.index.read_at(length, at)
        return [json.loads(line) for line in zlib.decompress(packed).decode().split("\n")]

    def record(self, at: int, length: int) -> dict:
        return parse_record(self.archive.read_at(length, at))

    def find(self, key: str):
        """All records with a key: binary search in the directory, then in the block; equal keys
        may go on through further blocks and begin in the one before."""
        k = max(0, bisect.bisect_left(self.first_keys, key) - 1)
        while k < len(self.directory) and self.first_keys[k] <= key:
            lines = self.block(k)
            keys = [line[0] for line in lines]
            for line in lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]:
                yield self.record(line[2], line[3])
            k += 1


FIELDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _batch(records: list[dict], more: dict | None = None):
    import pyarrow as pa

    types = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64()}
    types |= {"payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    columns = {n: pa.array([r[n] for r in records], t) for n, t in types.items()}
    return pa.RecordBatch.from_pydict(columns | (more or {}))


def read_captures(spark: SparkSession, folder: str) -> DataFrame:
    """All records by way of the index, one task per part: the fields of each, without payload."""
    ship(spark)
    parts = [p["part"] for p in read_manifest(folder)["parts"]]

    def read(batches):
        for batch in batches:
            for number in batch.column(0).to_pylist():
                part = Archive(folder, parts[number])
                for k in range(len(part.directory)):
                    yield _batch([part.record(at, length) for _, _, at, length in part.block(k)])

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(read, FIELDS)


def find_captures(urls: DataFrame, folder: str) -> DataFrame:
    """Captures of the URLs in column `url`: the fields of each record with `key`. A URL goes to
    the parts whose key range can hold it (by the parts' first keys, one per file), and is looked
    up there by binary search. Distinct keys are looked up once."""
    spark = urls.sparkSession
    ship(spark)
    parts = read_manifest(folder)["parts"]
    keys = urls.where(F.col("url").isNotNull()).select(surt(F.col("url")).alias("key")).distinct()
    ranges = [(p["part"], p["first_key"], parts[i + 1]["first_key"] if i + 1 < len(parts) else None) for i, p in enumerate(parts)]
    held = F.broadcast(spark.createDataFrame(ranges, "part int, low string, high string"))  # one row per file
    placed = keys.join(held, (F.col("key") >= F.col("low")) & (F.col("high").isNull() | (F.col("key") <= F.col("high"))))
    placed = placed.repartition("part").sortWithinPartitions("part", "key")

    def look(batches):
        import pyarrow as pa

        part, opened = None, None
        for batch in batches:
            found, asked = [], []
            for number, key in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()):
                if number != part:
                    part, opened = number, Archive(folder, number)
                for record in opened.find(key):
                    found.append(record)
                    asked.append(key)
            yield _batch(found, {"key": pa.array(asked, pa.string())})

    return placed.select("key", "part").mapInArrow(look, FIELDS + ", key string")
