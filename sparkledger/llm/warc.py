"""WARC archives with dictionary compression.

A Zstandard dictionary is built from a bounded sample of records.  Each archive begins with it in a
skippable frame, and each record is a frame of its own, compressed with that dictionary, so any record
can be read alone.  Of records with equal payloads of ``LEAST_REVISIT`` bytes or more, the one with the
smallest page_id is a response and the others revisit it.
"""

from __future__ import annotations

import datetime
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkledger.llm import common

#: Fixed value: the magic number of a skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
LEAST_REVISIT = 100
#: Records the dictionary is built from and the bytes taken of each, at most; and the dictionary's size.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 4096, 64 << 10
#: A task starts a new archive beyond this size.
ARCHIVE_BYTES = 64 << 20
LEVEL = 1


def record_id(page_id, digest: str, place: str) -> str:
    """The same for the same page and payload; a page without an id has one by its place."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place if page_id is None else page_id}:{digest}')}>"


def _record(kind: str, date: str, identity: str, kind_of_block: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC 1.1 record."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", identity), ("WARC-Date", date), *fields, ("Content-Type", kind_of_block), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, digest: str, refers_to, refers_url, date: str, place: str) -> bytes:
    """A page's response with its payload, or the revisit of another page that has the same: then without payload."""
    line = lambda text: (text or "urn:unknown").replace("\r", "").replace("\n", "")
    fields = [("WARC-Target-URI", line(url)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-Id", "" if page_id is None else str(page_id)), ("X-Has-Uri", str(int(url is not None)))]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return _record("response", date, record_id(page_id, digest, place), "application/http; msgtype=response", fields, head + payload)
    fields += [
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers_to, digest, "")),
        ("WARC-Refers-To-Target-URI", line(refers_url)), ("WARC-Refers-To-Date", date), ("X-Refers-To-Page", str(refers_to)),
    ]
    return _record("revisit", date, record_id(page_id, digest, place), "application/http; msgtype=response", fields, head)


def info_record(name: str, date: str) -> bytes:
    """What every archive begins with."""
    return _record("warcinfo", date, record_id(None, "", name), "application/warc-fields", [("WARC-Filename", name)], b"software: sparkledger\r\nformat: WARC File Format 1.1\r\n")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("this is no WARC record")
    fields = dict((k.lower(), v) for k, v in (x.split(": ", 1) for x in lines[1:]))
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return fields, rest[:size]


def parse_http(block: bytes) -> tuple[int, bytes]:
    """The payload's length as the HTTP header has it, and what follows the header."""
    head, rest = block.split(b"\r\n\r\n", 1)
    sizes = [int(x.split(b":", 1)[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return sizes[0], rest


def build_dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """A dictionary from at most ``SAMPLE_RECORDS`` different records, those whose hashes are smallest; empty if they are too few."""
    import zstandard

    # A first sieve by hash leaves about four times as many over all tasks, so no task sends many to the driver.
    filled = pages.where(F.length(html_col) > 0)
    different = filled.agg(F.approx_count_distinct(F.xxhash64(html_col))).first()[0]
    share = min(1.0, (4 * SAMPLE_RECORDS + 1000) / max(different, 1))
    some = filled.select(F.substring(html_col, 1, SAMPLE_BYTES).alias("t"), F.xxhash64(html_col).alias("h"))
    some = some.where(F.pmod("h", F.lit(1 << 20)) <= int(share * (1 << 20))).groupBy("h").agg(F.min("t").alias("t"))
    texts = [r["t"].encode() for r in some.orderBy("h", "t").limit(SAMPLE_RECORDS).collect()]
    if len(texts) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, texts)) // 8)), texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # samples too short or too alike for a dictionary
        return b""


class _Archive:
    def __init__(self, store, root: str, name: str, dictionary: bytes):
        self.store, self.final, self.attempt = store, f"{root}/{name}", f"{root}/_{name}-{TaskContext.get().taskAttemptId()}"
        self.out, self.size, self.records = store.open_output_stream(self.attempt, compression=None), 0, 0
        if dictionary:
            self.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)

    def write(self, data: bytes):
        self.out.write(data)
        self.size += len(data)

    def close(self):
        self.out.close()
        self.store.move(self.attempt, self.final)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str | None = None) -> DataFrame:
    """Writes all pages as archives below ``path`` and returns them: path, n_records, n_bytes.

    ``date`` is the records' WARC-Date (the time of the call, if none is given).  A null html is an empty payload.  A page with a null page_id is always a response and is not referred
    to; pages that share the smallest page_id of a payload are all responses.
    """
    from pyarrow import fs

    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    dictionary = build_dictionary(pages, html_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(html_col, F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    # Only payloads that occur again are joined back; the counts are summed in each task before they are sent.
    again = rows.where((F.octet_length("html") >= LEAST_REVISIT) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first_page"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(again, "digest", "left")

    def tasks(batches):
        import zstandard

        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        part, number, archive, done = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for digest, page, url, html, first, first_url in zip(*(c.to_pylist() for c in batch.columns)):
                if archive is None:
                    name = f"part-{part:06d}-{number:04d}.warc.zst"
                    archive = _Archive(store, root, name, dictionary)
                    archive.write(packer.compress(info_record(name, date)))
                again = first is not None and page is not None and page != first
                archive.write(packer.compress(page_record(page, url, html.encode(), digest, first if again else None, first_url, date, f"{name}:{archive.records}")))
                archive.records += 1
                if archive.size > ARCHIVE_BYTES:
                    archive.close()
                    done.append(archive)
                    archive, number = None, number + 1
        if archive is not None:
            archive.close()
            done.append(archive)
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{path}/{a.final.rsplit('/', 1)[1]}" for a in done], pa.string()), pa.array([a.records for a in done], pa.int64()), pa.array([a.size for a in done], pa.int64())],
            names=["path", "n_records", "n_bytes"],
        )

    return rows.select("digest", "page_id", "url", "html", "first_page", "first_url").mapInArrow(tasks, "path string, n_records long, n_bytes long")


def _frames(stream):
    """The records of an archive: its dictionary is read from the first frame, then each frame by itself."""
    import zstandard

    head = stream.read(8)
    dictionary = None
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
        dictionary, head = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", head[4:])[0])), b""
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    held = head
    while True:
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not held:
                held = stream.read(1 << 20)
                if not held:
                    if parts:
                        raise ValueError("the archive ends within a record")
                    return
            parts.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def read(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """One row per record of the archives: page_id, url, record_type, payload_digest, payload_bytes, refers_to and html.

    A revisit has no html here: it stands in the record that it refers to.  Responses' digests and lengths are
    taken from the payload that was read.
    """
    from pyarrow import fs

    def tasks(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for raw in _frames(stream):
                        fields, block = parse_record(raw)
                        if fields["warc-type"] == "warcinfo":
                            continue
                        size_then, block = parse_http(block)
                        kind, page, refers = fields["warc-type"], fields["x-page-id"], fields.get("x-refers-to-page")
                        whole = kind == "response"
                        digest = hashlib.sha256(block).hexdigest() if whole else fields["warc-payload-digest"].split(":", 1)[1]
                        length = len(block) if whole else size_then
                        url = fields["warc-target-uri"] if fields["x-has-uri"] == "1" else None
                        rows.append((int(page) if page else None, url, kind, digest, length, int(refers) if refers else None, block.decode() if whole else None))
                        size += len(raw)
                        if size > common.SLICE_BYTES:
                            yield _batch(rows)
                            rows, size = [], 0
                yield _batch(rows)

    spread = archives.select("path").repartition(common.shuffle_width(spark), "path")
    return spread.mapInArrow(tasks, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, html string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "html"]
    columns = list(zip(*rows)) if rows else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
