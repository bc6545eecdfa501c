"""SentencePiece encoding and decoding by a table of distinct chunks.

A text is normalised by the model and cut where no piece can reach across: before a white-space
marker, around characters that no longer piece holds, and between two classes of characters that
stand side by side in no piece. Chunks are counted over the whole corpus; the most frequent ones
are segmented once each, and every text's ids are put together from that table by position.

The table has at most `table_rows` chunks of at most LONGEST characters, so it may be sent to all
tasks. A chunk that is too rare or too long for it is segmented where it stands, which for a chunk
that occurs once is the only place. Results don't depend on the size of the table.

Null texts are empty: the end id alone, decoded as the empty text. Rows are independent, so null or
repeated doc_ids and repeated rows give their own rows; an empty table gives no rows. Very long texts
are cut like others, one text in memory at a time. Only doc_id and text are read, so other
columns may have any name.
"""

from __future__ import annotations

import functools
import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import stored

MARK = "▁"
#: A character outside longer pieces: whatever follows it is segmented by itself.
LEAD = "\n"
TABLE_ROWS = 400_000
LONGEST = 64
#: Distinct chunks that a task counts before it hands the counts on.
FLUSH = 300_000
#: Chunk counts are told apart by bins of 1/16 relative width when the table is cut.
BINS = 16


class Cutter:
    """A model, and a pattern of chunks that its pieces can't cross."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (self.model.is_byte, self.model.is_control, self.model.is_unknown)
        n = self.model.vocab_size()
        pieces = [self.model.id_to_piece(i) for i in range(n) if not any(f(i) for f in special)]
        beside = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        if any(b[1] == MARK != b[0] for b in beside):
            raise ValueError("pieces of this model cross white-space markers")
        inner = {c for b in beside for c in b} - {MARK}
        self.lead = len(self.model.encode(LEAD))
        self.lead_id = self.model.encode(LEAD)[-1]
        self.names = [str(i) for i in range(n)]
        if LEAD in inner or self.model.is_unknown(self.lead_id) or self.model.normalize(f"{LEAD}{MARK}{MARK}a") != f"{MARK}{LEAD}{MARK}{MARK}a":
            raise ValueError("this model changes white space")
        # `first` stand only before other characters of a chunk; `last` is followed by none of `first`.
        last = {c for c in inner if c.isalpha()}
        first = inner - last
        while moved := {b[1] for b in beside if b[0] in last and b[1] in first}:
            last, first = last | moved, first - moved
        kind = lambda chars: "".join(map(re.escape, sorted(chars)))
        a, b = kind(first) or "^\\s\\S", kind(last) or "^\\s\\S"
        self.pattern = re.compile(f"{MARK}*[{a}]*[{b}]+|{MARK}*[{a}]+|{MARK}+|[^{MARK}{kind(inner)}]")

    def chunks(self, text: str) -> list[str]:
        return self.pattern.findall(self.model.normalize(text))

    def segment(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks of normalised text, as 32-bit integers.

        They are encoded as one text with LEAD before each, which ends a chunk and has one id of its own.
        """
        apart = [c for c in chunks if LEAD not in c]
        ids = np.array(self.model.encode(LEAD + LEAD.join(apart))[self.lead :], "<i4")
        raw, cuts = ids.tobytes(), np.flatnonzero(ids == self.lead_id).tolist()
        made = {c: raw[4 * i : 4 * j] for c, i, j in zip(apart, [0, *(k + 1 for k in cuts)], [*cuts, len(ids)], strict=True)} if apart else {}
        rest = [c for c in chunks if LEAD in c]
        return made | {c: np.array(self.model.encode(LEAD + c)[self.lead :], "<i4").tobytes() for c in rest}


@functools.lru_cache(maxsize=2)
def cutter(path: str) -> Cutter:
    """One for each worker process."""
    return Cutter(path)


def chunk_counts(docs: DataFrame, model: str) -> DataFrame:
    """(chunk, n) of every chunk of all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut, seen = cutter(model), Counter()
        counted = lambda: pd.DataFrame({"chunk": list(seen), "n": list(seen.values())})
        for batch in batches:
            for text in batch["text"]:
                seen.update(cut.chunks(text))
                if len(seen) > FLUSH:
                    yield counted()
                    seen.clear()
        if seen:
            yield counted()

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(count, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def chunk_table(docs: DataFrame, model: str, rows: int = TABLE_ROWS) -> DataFrame:
    """(chunk, ids): the most frequent chunks, at most `rows`, each segmented once.

    The cut is by frequency bin: a bin is taken whole or not at all, so no order of all chunks
    is needed. Bins of chunks that occur once are left out, as a table saves nothing there.
    """
    level = F.floor(F.log2("n") * BINS).cast("int").alias("level")
    counts = stored(chunk_counts(docs, model).filter(f"n > 1 and char_length(chunk) <= {LONGEST}"), "chunks")
    sizes = counts.groupBy(level).count().orderBy(F.desc("level")).collect()  # a few hundred levels
    least, left = None, rows
    for bin_ in sizes:
        left -= bin_["count"]
        if left < 0:
            break
        least = bin_["level"]

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = cutter(model)
        for batch in batches:
            chunks = batch["chunk"].tolist()
            yield pd.DataFrame({"chunk": chunks, "ids": list(map(cut.segment(chunks).__getitem__, chunks))})

    kept = counts.filter(level >= least) if least is not None else counts.limit(0)
    return kept.select("chunk").mapInPandas(segment, "chunk string, ids binary")


_LOADED: dict[str, dict[str, bytes]] = {}


def _known(name: str, sent) -> dict[str, bytes]:
    """The table of a broadcast, built once in a worker process; only the newest is held."""
    if name not in _LOADED:
        _LOADED.clear()
        table = pa.ipc.open_stream(sent.value).read_all()
        _LOADED[name] = dict(zip(table["chunk"].to_pylist(), table["ids"].to_pylist(), strict=True))
    return _LOADED[name]


def encode_text(text: str, cut: Cutter, known: dict[str, bytes]) -> list[int]:
    """Ids of a text, joined from the ids of its chunks in their order."""
    found = cut.chunks(text)
    rare = cut.segment([c for c in set(found) if c not in known])
    return np.frombuffer(b"".join([known[c] if c in known else rare[c] for c in found]), "<i4").tolist()


def with_ids(
    docs: DataFrame, model: str, schema: str, per_text: Callable[[list[int], Cutter], tuple], rows: int = TABLE_ROWS
) -> DataFrame:
    """(doc_id, …): per_text gets the ids of a text with the end id, and gives the values of `schema`."""
    spark = docs.sparkSession
    table = chunk_table(docs, model, rows).toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    sent = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
    name = uuid.uuid4().hex
    names = [c.split()[0] for c in schema.split(",")]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut, known = cutter(model), _known(name, sent)
        end = cut.model.eos_id()
        for batch in batches:
            made = [per_text([*encode_text(t, cut, known), end], cut) for t in batch["text"]]
            frame = pd.DataFrame(made, columns=names)
            frame.insert(0, "doc_id", batch["doc_id"].array)
            yield frame

    rows_in = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType
    made = rows_in.mapInPandas(encode, f"doc_id string, {schema}")
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))


def encoded(docs: DataFrame, model: str, rows: int = TABLE_ROWS) -> DataFrame:
    """(doc_id, ids, decoded) of every text: its ids with the end id, and the text they decode to."""
    return with_ids(docs, model, "ids array<int>, decoded string", lambda ids, cut: (ids, cut.model.decode(ids)), rows)


def _digest(ids: list[int], cut: Cutter) -> tuple[int, str, str]:
    sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
    return len(ids), sha(" ".join([cut.names[i] for i in ids])), sha(cut.model.decode(ids))


def digests(docs: DataFrame, model: str, rows: int = TABLE_ROWS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text."""
    return with_ids(docs, model, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digest, rows)
