"""Packing documents into training sequences: vector bin packing by the dot-product heuristic.

A sequence has three limits: tokens, segments (pieces) and loss-bearing tokens. Each task fills one sequence at a
time from a block of documents. Among the pieces that fit, it places the one whose demand has the largest dot
product with what the sequence has left, both as shares of the limits. When nothing fits, the most demanding document
is cut so that its front fills the gap. A sequence that cannot be filled is dealt into sequences whose lengths
are powers of two, which need no padding; that happens to at most one sequence of a task, unless the limits on
segments or loss bind.

No shuffle: blocks are made of neighbouring rows of a partition, whose leftovers go on to the partition's next block.
Sequence numbers hold the partition's number, so a task that runs again gives the same rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.mapping import arrow_map
from medloom.llm.vocab import BATCH_CHARS, encoder

MAX_TOKENS = 2048
MAX_SEGMENTS = 256
BLOCK_DOCUMENTS = 4096
BLOCK_TOKENS = 4_000_000
KEPT_PIECES = 1_500_000
#: Tokens and pieces after which finished sequences leave the worker.
EMIT_TOKENS = 500_000
EMIT_PIECES = 5_000


class Packer:
    """Fills sequences from documents of known token and prompt lengths."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int):
        if min(max_tokens, max_segments, max_loss) < 1:
            raise ValueError("limits are positive")
        self.limits = np.array([max_tokens, max_segments, max_loss], np.float64)
        self.whole = np.array([max_tokens, max_segments, max_loss], np.int64)
        self.doc = np.empty(0, np.int64)  # waiting documents: number, first token left, tokens, prompt tokens
        self.start = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.prompt = np.empty(0, np.int64)

    def add(self, doc: np.ndarray, size: np.ndarray, prompt: np.ndarray) -> None:
        self.doc = np.append(self.doc, doc)
        self.start = np.append(self.start, np.zeros(len(doc), np.int64))
        self.size = np.append(self.size, size)
        self.prompt = np.append(self.prompt, np.minimum(prompt, size))

    def _front(self, i: int, tokens: int, loss: int) -> int:
        """The longest front of what is left of document i with at most so many tokens and loss-bearing tokens."""
        free = max(0, self.prompt[i] - self.start[i])
        return int(min(self.size[i] - self.start[i], tokens, free + loss))

    def fill(self, last: bool) -> Iterator[list[tuple[int, int, int]]]:
        """Sequences as lists of (document, start, length). Unless ``last``, stops when less than a sequence is left."""
        tokens, segments, loss = (int(x) for x in self.whole)
        left = self.size - self.start
        bears = left - np.maximum(0, self.prompt - self.start)
        waiting = left > 0
        while waiting.any() and (last or int(left[waiting].sum()) >= 4 * tokens):
            room = self.whole.copy()
            pieces: list[tuple[int, int, int]] = []
            while room.min() > 0 and waiting.any():
                share = room / self.limits
                score = left * (share[0] / tokens) + bears * (share[2] / loss) + share[1] / segments
                fits = waiting & (left <= room[0]) & (bears <= room[2])
                if fits.any():
                    i = int(np.argmax(np.where(fits, score, -1.0)))
                    length = int(left[i])
                else:
                    i = int(np.argmax(np.where(waiting, score, -1.0)))
                    length = self._front(i, int(room[0]), int(room[2]))
                pieces.append((int(self.doc[i]), int(self.start[i]), length))
                room -= (length, 1, max(0, self.start[i] + length - max(self.start[i], self.prompt[i])))
                self.start[i] += length
                left[i] -= length
                bears[i] = left[i] - max(0, self.prompt[i] - self.start[i])
                waiting[i] = left[i] > 0
            yield from self._powers(pieces, tokens - int(room[0]))
        self.doc, self.start, self.size, self.prompt = (x[waiting] for x in (self.doc, self.start, self.size, self.prompt))

    def _powers(self, pieces: list[tuple[int, int, int]], used: int) -> Iterator[list[tuple[int, int, int]]]:
        """A full sequence as it is; another as sequences of power-of-two lengths."""
        if used == self.whole[0]:
            yield pieces
            return
        pieces = pieces[::-1]
        for bit in reversed(range(used.bit_length())):
            if not used >> bit & 1:
                continue
            need, own = 1 << bit, []
            while need:
                doc, start, length = pieces.pop()
                part = min(need, length)
                own.append((doc, start, part))
                if part < length:
                    pieces.append((doc, start + part, length - part))
                need -= part
            yield own


def _pack(path: str, end_id: int, limits: tuple[int, int, int], with_ids: bool, block: tuple[int, int], kept: int = KEPT_PIECES, chars: int = BATCH_CHARS) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path, kept)
        packer = Packer(*limits)
        base = TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u4").tobytes()
        ids: dict[int, bytes] = {}  # of documents not yet wholly placed
        names: dict[int, object] = {}
        left: dict[int, int] = {}
        sequence = number = 0

        def emit(last: bool, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            out: dict[str, list] = {c: [] for c in ("id", "start", "length", "crc", "tokens", "sequence", "offset", "ids")}
            held = 0
            for pieces in packer.fill(last):
                offset = 0
                for doc, start, length in pieces:
                    own = ids[doc]
                    part = own[4 * start : 4 * (start + length)]
                    row = (names[doc], start, length, zlib.crc32(part), len(own) // 4, base + sequence, offset)
                    for column, value in zip(out, row, strict=False):
                        out[column].append(value)
                    if with_ids:
                        out["ids"].append(part)
                    offset += length
                    left[doc] -= length
                    if not left[doc]:
                        del ids[doc], names[doc], left[doc]
                sequence += 1
                held += offset
                if held >= EMIT_TOKENS or len(out["id"]) >= EMIT_PIECES:
                    yield from rows_of(out, id_type)
                    held = 0
            yield from rows_of(out, id_type)

        def rows_of(out: dict[str, list], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            """The pieces in ``out``, which is left empty."""
            columns = {
                "_id": pa.array(out["id"], id_type),
                "start": pa.array(out["start"], pa.int64()),
                "length": pa.array(out["length"], pa.int64()),
                "ids_crc32": pa.array(out["crc"], pa.int64()),
                "doc_tokens": pa.array(out["tokens"], pa.int64()),
                "sequence_id": pa.array(out["sequence"], pa.int64()),
                "offset": pa.array(out["offset"], pa.int64()),
            }
            if with_ids:
                bounds = np.cumsum([0, *out["length"]], dtype=np.int32)
                columns["ids"] = pa.ListArray.from_arrays(bounds, np.frombuffer(b"".join(out["ids"]), "<i4"))
            for values in out.values():
                values.clear()
            yield from pa.table(columns).to_batches()

        fresh: list[tuple[int, int, int]] = []
        tokens, id_type = 0, pa.null()

        def block_done(last: bool) -> Iterator[pa.RecordBatch]:
            if fresh:
                packer.add(*np.array(fresh, np.int64).T)
            fresh.clear()
            yield from emit(last, id_type)

        for batch in batches:
            id_type = batch.column("_id").type
            prompts = tokenizer.encode(batch.column("_prompt"), chars) if "_prompt" in batch.schema.names else None
            for name, own in zip(batch.column("_id").to_pylist(), tokenizer.encode(batch.column("_text"), chars), strict=True):
                prompt = next(prompts) if prompts is not None else b""
                own = prompt + own + end
                ids[number], names[number], left[number] = own, name, len(own) // 4
                fresh.append((number, len(own) // 4, len(prompt) // 4))
                number += 1
                tokens += len(own) // 4
                if len(fresh) >= block[0] or tokens >= block[1]:
                    tokens = 0
                    yield from block_done(False)
        yield from block_done(True)

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    end_id: int = 1,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    with_ids: bool = True,
    kept_pieces: int = KEPT_PIECES,
    column_chars: int = BATCH_CHARS,
) -> DataFrame:
    """Pack documents, or prompts with their answers, into sequences under three limits at once.

    A document's ids are those of its prompt (if any; bearing no loss), its text and ``end_id``. Every id lies in
    exactly one piece. Returns per piece: the id, start (ids of the document before it), length, ids_crc32 (unsigned,
    over little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset (in the sequence, without gaps), and with
    ``with_ids`` the ids. A missing text is empty, so its document is one end id. Rows that repeat an id are documents
    of their own. Other columns are ignored; an empty table gives an empty table. Workers remember the ids of about ``kept_pieces`` words
    and look up those of ``column_chars`` bytes of text at once; neither changes a row.
    """
    def text(c: str):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

    columns = [F.col(f"`{id_col}`").alias("_id"), text(text_col).alias("_text")]
    if prompt_col:
        columns.append(text(prompt_col).alias("_prompt"))
    rows = docs.select(*columns)
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    fields = [rows.schema["_id"], *(T.StructField(c, T.LongType()) for c in names)]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    limits = (max_tokens, max_segments, max_loss or max_tokens)
    run = _pack(tokenizer_path, end_id, limits, with_ids, (BLOCK_DOCUMENTS, BLOCK_TOKENS), kept_pieces, column_chars)
    return arrow_map(rows, run, T.StructType(fields)).withColumnRenamed("_id", id_col)
