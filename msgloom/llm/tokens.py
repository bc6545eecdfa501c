"""Token ids as patched frame-of-reference files.

Documents are dealt out in ascending doc_id order; each task encodes its texts and writes
shards. Ids form blocks of 256: the block's minimum is subtracted, a width is chosen so that
it holds nine tenths of the values, and larger ones go to an exception list. A shard ends
with its tables (exceptions, blocks with their starts, documents) and a footer.

Null texts are empty and have the end id only. A null doc_id sorts first. Rows with the same
doc_id follow in the order of their texts, so repeated rows are equal wherever they stand.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import file_system, stored
from msgloom.sources.workspace import new_folder

END_ID = 1
BLOCK = 256
PERCENTILE = 0.9
#: A shard is closed at the first document end after so many ids.
SHARD_IDS = 16_000_000
MAGIC = b"PFORIDS1"
FOOTER = struct.Struct("<8sQQQQ")
GROUP = 1024
#: Pieces of a generation that a worker process remembers, and characters of the longest of them.
MEMO, LONGEST = 400_000, 64


class Encoder:
    """Ids of texts by a tokenizer file.

    `by_words`: for tokenizers that drop white space and treat letters, single digits and runs of
    other characters apart. A text is cut into such pieces, and the ids of pieces met before come
    from a memo of two generations: the older one goes when the newer is full. Words with other
    characters than PLAIN (which are composed, and get lower case letter by letter) stay whole.
    """

    PLAIN = re.compile(r"[\t-\r -~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]*")
    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00C0-\u00FF]+|[0-9]|[^a-z0-9\u00C0-\u00FF\s]+")
    SPECIAL = "<|"

    def __init__(self, path: str, by_words: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = by_words
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # How the tokenizer writes each plain character before its model sees it.
        self.written = {}
        if by_words:
            letters = [c for c in map(chr, range(33, 256)) if self.PLAIN.fullmatch(c) and c == c.lower()]
            self.written = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _is_plain(self, text: str) -> bool:
        return self.SPECIAL not in text and self.PLAIN.fullmatch(text) is not None

    def _cut(self, text: str) -> list[str]:
        if self._is_plain(text):
            return self.PIECE.findall(text.lower())
        words = (w.decode("utf-8") for w in text.encode("utf-8").split())
        return [p for w in words for p in (self.PIECE.findall(w.lower()) if self._is_plain(w) else [w])]

    def _by_tokenizer(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of pieces or words, encoded as one text; an id belongs to the part at its offset."""
        made = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        starts = np.cumsum([0] + [len(w) + 1 for w in parts])
        at = np.array([a for a, _ in made.offsets], np.int64)
        cuts = np.searchsorted(at, starts).tolist()
        raw = np.array(made.ids, "<u4").tobytes()
        return {w: raw[4 * a : 4 * b] for w, a, b in zip(parts, cuts, cuts[1:], strict=False)}

    def _by_model(self, part: str) -> bytes:
        """Ids of one plain piece: the tokenizer would hand it to its model as it is."""
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(part.translate(self.written))])

    def _learn(self, parts: set[str]) -> dict[str, bytes]:
        """The ids of all parts; those not known are encoded, and remembered unless very long."""
        found = {p: self.now[p] for p in parts if p in self.now}
        new = {p: self.old[p] for p in parts if p in self.old and p not in found}
        missing = [p for p in parts if p not in found and p not in new]
        plain = {p for p in missing if self._is_plain(p)}
        new |= {p: self._by_model(p) for p in plain}
        if whole := [p for p in missing if p not in plain]:
            new |= self._by_tokenizer(whole)
        if len(self.now) + len(new) > MEMO:
            self.now, self.old = {}, self.now
        if len(new) <= MEMO:
            self.now |= {p: ids for p, ids in new.items() if len(p) <= LONGEST}
        return found | new

    def __call__(self, text: str) -> np.ndarray:
        if not self.by_words:
            return self.plain(text)
        parts = self._cut(text)
        try:
            ids = b"".join(map(self.now.__getitem__, parts))
        except KeyError:
            ids = b"".join(map(self._learn(set(parts)).__getitem__, parts))
        return np.frombuffer(ids, "<u4")


@functools.lru_cache(maxsize=2)
def encoder(path: str, by_words: bool = True) -> Encoder:
    """One for each worker process, whose memo serves all its tasks."""
    return Encoder(path, by_words)


def pack_blocks(ids: np.ndarray, percentile: float = PERCENTILE):
    """(minima, widths, payloads, exception counts, positions, values) of whole blocks."""
    blocks = ids.reshape(-1, BLOCK).astype(np.int64)
    least = blocks.min(axis=1)
    rest = blocks - least[:, None]
    length = np.frexp(rest.astype(np.float64))[1]
    rank = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    width = np.partition(length, rank, axis=1)[:, rank]
    patched = length > width[:, None]
    block, position = np.nonzero(patched)
    values = rest[block, position]
    rest[patched] = 0
    payloads: list[bytes] = [b""] * len(blocks)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        bits = (rest[rows][:, :, None] >> np.arange(w)) & 1
        packed = np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        for row, data in zip(rows.tolist(), packed, strict=True):
            payloads[row] = data.tobytes()
    counts = np.bincount(block, minlength=len(blocks))
    return least, width, payloads, counts, position, values


def unpack_blocks(payload: np.ndarray, start, least, width, counts, position, value) -> np.ndarray:
    """The ids of blocks whose bytes begin at `start` in payload."""
    rest = np.zeros((len(least), BLOCK), np.int64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        at = start[rows][:, None] + np.arange(BLOCK // 8 * w)
        bits = np.unpackbits(payload[at], axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        rest[rows] = bits.astype(np.int64) @ (1 << np.arange(w, dtype=np.int64))
    rest[np.repeat(np.arange(len(least)), counts), position] = value
    return (rest + least[:, None]).reshape(-1)


class ShardWriter:
    """Writes one shard: blocks as they fill, tables and footer at the end."""

    def __init__(self, folder: str, name: str, attempt: int):
        self.store, path = file_system(f"{folder}/{name}")
        self.store.create_dir(path.rpartition("/")[0], recursive=True)
        self.path, self.part = path, f"{path}.{attempt}.part"
        self.out = self.store.open_output_stream(self.part, compression=None)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.at = 0
        self.docs: list[tuple[int, int, int]] = []
        self.tables: list[list] = [[], [], [], [], [], []]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids)))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= GROUP * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        if last and len(ids) % BLOCK:
            ids = np.concatenate([ids, np.full(-len(ids) % BLOCK, ids[-1], ids.dtype)])
        whole = len(ids) // BLOCK * BLOCK
        for a in range(0, whole, GROUP * BLOCK):
            least, width, payloads, counts, position, values = pack_blocks(ids[a : min(a + GROUP * BLOCK, whole)])
            sizes = np.array([len(p) for p in payloads])
            starts = self.at + np.cumsum(sizes) - sizes
            self.at += int(sizes.sum())
            self.out.write(b"".join(payloads))
            parts = (starts, least, width, counts, position, values)
            for kept, part, kind in zip(self.tables, parts, ("<u8", "<u4", "u1", "<u2", "<u2", "<u4"), strict=True):
                kept.append(part.astype(kind))
        self.waiting = [ids[whole:]]
        self.n_waiting = len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        table = [np.concatenate(t) if t else np.zeros(0, "u1") for t in self.tables]
        docs = np.array(self.docs, np.int64).reshape(-1, 3)
        for part in (*table, docs[:, 0].astype("<i8"), docs[:, 1].astype("u1"), docs[:, 2].astype("<u8")):
            self.out.write(part.tobytes())
        n_blocks = len(table[0])
        self.out.write(FOOTER.pack(MAGIC, n_blocks, len(table[4]), len(docs), self.at))
        self.out.close()
        self.store.move(self.part, self.path)


class ShardReader:
    """Documents of a shard, and their ids in pieces."""

    def __init__(self, path: str):
        store, name = file_system(path)
        self.file = store.open_input_file(name)
        end = self.file.size() - FOOTER.size
        magic, blocks, patches, docs, payload = FOOTER.unpack(self.file.read_at(FOOTER.size, end))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a whole shard")
        at = payload

        def column(n: int, kind: str) -> np.ndarray:
            nonlocal at
            size = n * np.dtype(kind).itemsize
            data = np.frombuffer(self.file.read_at(size, at), kind)
            at += size
            return data

        self.start, self.least, self.width = column(blocks, "<u8"), column(blocks, "<u4"), column(blocks, "u1")
        self.counts = column(blocks, "<u2")
        self.position, self.value = column(patches, "<u2"), column(patches, "<u4")
        self.doc_id, self.has_id, self.length = column(docs, "<i8"), column(docs, "u1"), column(docs, "<u8")
        self.payload = payload

    def ids(self, first_block: int = 0, last_block: int | None = None) -> Iterator[np.ndarray]:
        """Ids of the blocks, padding of the last one included; the index gives their place."""
        stop = len(self.start) if last_block is None else last_block
        patch = np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])
        for a in range(first_block, stop, GROUP):
            b = min(a + GROUP, stop)
            low = int(self.start[a])
            high = int(self.start[b]) if b < len(self.start) else self.payload
            data = np.frombuffer(self.file.read_at(high - low, low), np.uint8)
            cut = slice(int(patch[a]), int(patch[b]))
            yield unpack_blocks(
                data, self.start[a:b].astype(np.int64) - low, self.least[a:b].astype(np.int64),
                self.width[a:b].astype(np.int64), self.counts[a:b], self.position[cut], self.value[cut],
            )

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc_id, number of ids, crc32 of the ids as little-endian 32-bit integers)."""
        pieces = self.ids()
        piece, at = b"", 0
        for doc, known, n in zip(self.doc_id.tolist(), self.has_id.tolist(), self.length.tolist(), strict=True):
            left, crc = 4 * n, 0
            while left:
                if at == len(piece):
                    piece, at = next(pieces).astype("<u4").tobytes(), 0
                size = min(left, len(piece) - at)
                crc = zlib.crc32(memoryview(piece)[at : at + size], crc)
                at += size
                left -= size
            yield (doc if known else None), n, crc


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, by_words: bool = True) -> DataFrame:
    """Write shards of docs (doc_id, text) and return their stored list.

    (part, shard, path, n_docs, n_ids) by shard; shards in the order (part, shard) follow doc_id.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part = task.partitionId()
        encode, end = encoder(tokenizer, by_words), np.array([end_id], "<u4")
        writer, done = None, []

        def finish() -> None:
            writer.close()
            done.append((part, len(done), writer.path_given, len(writer.docs), writer.n_ids))

        for batch in batches:
            for doc_id, known, text in zip(batch["doc_id"].tolist(), batch["known"].tolist(), batch["text"].tolist(), strict=True):
                if writer is None:
                    name = f"{part:06d}-{len(done):04d}.pfor"
                    writer = ShardWriter(folder, name, task.taskAttemptId())
                    writer.path_given = f"{folder}/{name}"
                writer.add(int(doc_id) if known else None, np.concatenate([encode(text), end]))
                if writer.n_ids >= SHARD_IDS:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        yield pd.DataFrame(done, columns=["part", "shard", "path", "n_docs", "n_ids"])

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select("doc_id", text).repartitionByRange("doc_id", F.xxhash64("text"))
    rows = rows.sortWithinPartitions("doc_id", "text")
    rows = rows.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text")
    return stored(rows.mapInPandas(write, "part int, shard int, path string, n_docs long, n_ids long"), "shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in listed shards."""
    before = Window.partitionBy(F.lit(0)).orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    listed = shards.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    n = max(1, shards.count())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, first in zip(batch["path"].tolist(), batch["first"].tolist(), strict=True):
                rows = []
                for doc_id, size, crc in ShardReader(path).documents():
                    rows.append((doc_id, first, size, crc))
                    first += size
                    if len(rows) == 10_000:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return listed.repartition(n, "path").mapInPandas(read, schema)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    return frame.astype({"doc_id": "Int64", "start": "int64", "n_tokens": "int64", "ids_crc32": "int64"})


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write docs as id files below `folder` (the shared folder by default) and read them back."""
    where = folder or new_folder(docs.sparkSession, "ids")
    return read_documents(write_ids(docs, where, tokenizer))
