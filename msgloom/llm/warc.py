"""WARC archives with a Zstandard dictionary, one frame per record.

Each archive begins with a skippable frame that holds a dictionary trained on records of that
archive; every record is a frame of its own, compressed with it. Of records with equal payloads
of at least MIN_REVISIT bytes, the one with the largest page_id holds the payload, others revisit it.

A null html is an empty payload, a null url the URI urn:x-unknown. Rows without a page_id revisit
a numbered page; without one they are responses. Rows that repeat the largest page_id are responses.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import file_system, stored
from msgloom.operators.bounded import salted_join
from msgloom.sources.workspace import new_folder

MIN_REVISIT = 1000
SALTS = 32
DATE = "1970-01-01T00:00:00Z"
#: Bounds of what a dictionary is trained on, its size, and the payload bytes of one archive.
SAMPLE_BYTES, SAMPLE_RECORDS, DICTIONARY_BYTES = 1 << 20, 500, 1 << 16
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
# fixed values of the formats
SKIPPABLE = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit of the record of page refers_to, which has the HTTP header only."""
    target = re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", url or "urn:x-unknown")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, digest, type, refers_to) of a record; a wrong payload is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda name: int(v) if (v := fields[name].strip("<>").removeprefix(ID_PREFIX)) else None
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its header")
    return number("WARC-Record-ID"), size, digest, kind, number("WARC-Refers-To") if kind == "revisit" else None


def dictionary(samples: list[bytes]) -> bytes:
    """Trained on the samples; empty where they are too few or too short to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    """Keeps the first records back until they are enough for a dictionary."""

    def __init__(self, folder: str, name: str, attempt: int):
        self.store, self.path = file_system(f"{folder}/{name}")
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.part = f"{self.path}.{attempt}.part"
        self.out = self.store.open_output_stream(self.part, compression=None)
        self.waiting: list[bytes] = []
        self.compress = None
        self.size = self.records = 0

    def add(self, raw: bytes) -> None:
        self.size += len(raw)
        self.records += 1
        if self.compress is None:
            self.waiting.append(raw)
            if self.size >= SAMPLE_BYTES or len(self.waiting) >= SAMPLE_RECORDS:
                self._start()
        else:
            self.out.write(self.compress(raw))

    def _start(self) -> None:
        import zstandard

        trained = dictionary(self.waiting)
        if trained:
            self.out.write(struct.pack("<II", SKIPPABLE, len(trained)) + trained)
        used = zstandard.ZstdCompressionDict(trained) if trained else None
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=used, write_checksum=True).compress
        for raw in self.waiting:
            self.out.write(self.compress(raw))
        self.waiting = []

    def close(self) -> None:
        if self.compress is None:
            self._start()
        self.out.close()
        self.store.move(self.part, self.path)


def read_archive(path: str) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    import zstandard

    store, name = file_system(path)
    with store.open_input_stream(name, compression=None) as stream:
        head = stream.read(8)
        used, left = None, head
        if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
            raw = stream.read(struct.unpack("<I", head[4:])[0])
            if raw.startswith(FRAME_MAGIC):
                raw = zstandard.ZstdDecompressor().decompress(raw)
            used, left = zstandard.ZstdCompressionDict(raw), b""
        reader = zstandard.ZstdDecompressor(dict_data=used)
        while left or (left := stream.read(1 << 16)):
            frame, parts = reader.decompressobj(), []
            while not frame.eof:
                if not left and not (left := stream.read(1 << 16)):
                    raise ValueError(f"{path} ends inside a record")
                parts.append(frame.decompress(left))
                left = frame.unused_data if frame.eof else b""
            yield b"".join(parts)


def with_revisits(pages: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """pages (page_id, url, html) with payload, size, digest and refers_to."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    groups = rows.filter(F.col("size") >= least).groupBy("digest")
    firsts = groups.agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = salted_join(rows, firsts, ["digest"], ["page_id", "url"], "left", SALTS)
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(other, F.col("first"))).drop("first")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write archives of pages (page_id, url, html) below folder; their stored list (path, n_records)."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, writer, done = TaskContext.get(), None, []
        names = ["page_id", "url", "payload", "size", "digest", "refers_to"]

        def finish() -> None:
            writer.close()
            done.append((f"{folder}/{writer.path.rpartition('/')[2]}", writer.records))

        for batch in batches:
            for page_id, url, payload, size, digest, refers_to in zip(*(batch[c] for c in names), strict=True):
                if writer is None:
                    name = f"pages-{task.partitionId():06d}-{len(done):04d}.warc.zst"
                    writer = ArchiveWriter(folder, name, task.taskAttemptId())
                whole = lambda v: None if pd.isna(v) else int(v)
                data = bytes(payload) if payload is not None else b""
                writer.add(record(whole(page_id), url, data, size, digest, whole(refers_to)))
                if writer.size >= ARCHIVE_BYTES:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        yield pd.DataFrame(done, columns=["path", "n_records"])

    rows = with_revisits(pages).select(
        F.col("page_id").cast("string").alias("page_id"), "url",
        F.when(F.col("refers_to").isNull(), F.col("payload").cast("binary")).alias("payload"),
        "size", "digest", F.col("refers_to").cast("string").alias("refers_to"),
    )
    return stored(rows.mapInPandas(write, "path string, n_records long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records in listed archives."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(rows: list[tuple]) -> pd.DataFrame:
            made = pd.DataFrame(rows, columns=names)
            return made.astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"})

        for batch in batches:
            for path in batch["path"]:
                rows = []
                for raw in read_archive(path):
                    rows.append(parse(raw))
                    if len(rows) == 5000:
                        yield frame(rows)
                        rows = []
                yield frame(rows)

    n = max(1, archives.count())
    return archives.select("path").repartition(n, "path").mapInPandas(read, schema)


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages as archives below `folder` (the shared folder by default) and read them back."""
    return read_archives(write_archives(pages, folder or new_folder(pages.sparkSession, "warc")))
