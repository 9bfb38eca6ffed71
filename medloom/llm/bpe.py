"""Byte pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token that can come last in its encoding. Its candidates are the
vocabulary's tokens that end there, which an automaton over the vocabulary reports (with all shorter suffixes).
A candidate is the last token if its predecessor, the last token of the prefix before it, is compatible: the two
next to each other are what merging would leave. Back-pointers from the word's end give the ids.

Ids are kept per distinct piece of text (bounded), as in ``vocab``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.mapping import arrow_map
from medloom.llm.vocab import batched, byte_letters, spaced_pieces

KEPT_PIECES = 700_000
KEPT_PAIRS = 500_000
#: Fixed value: the pattern that cuts text into words before merging.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


class PrefixEncoder:
    """Encoder and decoder of a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.bytes = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes.update({i: s.encode() for s, i in self.special.items()})
        self.split_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.rank: dict[int, int] = {}  # when a token is made; absent for single bytes
        self.halves: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for at, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            token, pair = vocab[left + right], (vocab[left], vocab[right])
            self.merge[pair] = at
            if token not in self.rank:
                self.rank[token], self.halves[token] = at, pair
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, tuple[str, bytes, int]] = {}
        self.tails: dict[str, tuple[str, bytes, int]] = {}
        reachable: dict[int, bool] = {}
        for token in sorted(vocab.values(), key=lambda t: self.rank.get(t, -1)):
            if token in self.halves:
                left, right = self.halves[token]
                reachable[token] = reachable[left] and reachable[right] and self._fits(left, right, self.rank[token])
            else:
                reachable[token] = len(self.bytes[token]) == 1
        self.automaton = ahocorasick.Automaton()
        for token, ok in reachable.items():
            if ok:
                self.automaton.add_word(self.bytes[token].decode("latin-1"), (token, len(self.bytes[token])))
        self.automaton.make_automaton()

    def _fits(self, left: int, right: int, before: int) -> bool:
        """Whether merging keeps the border between two finished tokens up to merge number ``before``.

        Goes back in time: takes the later of the two tokens' merges apart and looks whether the halves that then
        meet at the border would have merged first. Equal merges happen from left to right.
        """
        merge, rank, halves = self.merge, self.rank, self.halves
        while True:
            at = merge.get((left, right))
            if at is not None and at < before:
                return False
            made_left, made_right = rank.get(left, -1), rank.get(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                left, before = halves[left][1], made_left
            else:
                right, before = halves[right][0], made_right + 1

    def word_ids(self, word: bytes) -> list[int]:
        """The ids of one word."""
        size = len(word)
        last, pairs, never = [-1] * size, self.pairs, len(self.merge) + 1
        length = [0] * size
        for end, (token, width) in self.automaton.iter(word.decode("latin-1")):
            if length[end]:
                continue
            before = end - width
            if before >= 0:
                if not length[before]:
                    continue
                pair = (last[before], token)
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self._fits(*pair, never)
                if not fits:
                    continue
            last[end], length[end] = token, width
        ids, end = [], size - 1
        while end >= 0:
            ids.append(last[end])
            end -= length[end]
        ids.reverse()
        return ids

    def text_ids(self, text: str) -> list[int]:
        """The ids of a text. The strings of special tokens are those tokens."""
        if self.split_special is not None and any(s in text for s in self.special):
            parts = self.split_special.split(text)
        else:
            parts = [text]
        ids: list[int] = []
        for part in parts:
            if part in self.special:
                ids.append(self.special[part])
            else:
                for word in WORDS.findall(part):
                    ids += self.word_ids(word.encode())
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def _piece(self, piece: str) -> tuple[str, bytes, int]:
        ids = self.text_ids(piece)
        return ",".join(map(str, ids)), self.decode(ids), len(ids)

    def _learn(self, piece: str) -> tuple[str, bytes, int]:
        """A piece that follows a space. Commas and full stops after a letter or digit are a word of their own."""
        core = piece.rstrip(",.")
        if len(core) < len(piece) and core[-1:].isalnum():
            head = self.pieces.get(core) or self._learn(core)
            end = piece[len(core) :]
            if end not in self.tails:
                self.tails[end] = self._piece(end)
            tail = self.tails[end]
            own = (f"{head[0]},{tail[0]}", head[1] + tail[1], head[2] + tail[2])
        else:
            own = self._piece(" " + piece)
        self.pieces[piece] = own
        return own

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and digests of the ids joined by commas and of the text decoded from them."""
        if any(s in text for s in self.special):
            parts = [self._piece(text)]
        else:
            cut = spaced_pieces(text)
            known = self.pieces
            if len(known) > KEPT_PIECES:
                known.clear()
                self.tails.clear()
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            parts = []
            if cut[0]:
                parts.append(self._piece(cut[0]))
            for p in cut[1:]:
                own = known.get(p)
                parts.append(own if own is not None else self._learn(p))
        ids = ",".join([p[0] for p in parts if p[0]])
        text = b"".join([p[1] for p in parts]).decode("utf-8", "replace")
        count = sum([p[2] for p in parts])
        return count, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(path: str) -> PrefixEncoder:
    """The encoder of this worker process for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = PrefixEncoder(path)
    return _ENCODERS[path]


def _digests(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            done = [bpe.digest(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "_id": batch.column("_id"),
                    "n_tokens": pa.array([d[0] for d in done], pa.int64()),
                    "ids_sha256": pa.array([d[1] for d in done], pa.string()),
                    "decoded_sha256": pa.array([d[2] for d in done], pa.string()),
                }
            )

    return run


def _encode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            at = 0
            for group in batched(batch.column("_text").to_pylist()):
                ids = [bpe.text_ids(t) for t in group]
                yield pa.RecordBatch.from_pydict(
                    {
                        "_id": batch.column("_id").slice(at, len(group)),
                        "ids": pa.array(ids, pa.list_(pa.int32())),
                        "decoded": pa.array([bpe.decode(i).decode("utf-8", "replace") for i in ids], pa.string()),
                    }
                )
                at += len(group)

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every text and the text decoded from them: the id, ids, decoded.

    A missing text counts as empty and has no ids. Rows are independent: missing or repeated ids are kept as they
    are, other columns are ignored, an empty table gives an empty table.
    """
    rows = _texts(docs, id_col, text_col)
    fields = [rows.schema["_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return arrow_map(rows, _encode(tokenizer_path), T.StructType(fields)).withColumnRenamed("_id", id_col)


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`encode`, with n_tokens and digests in place of ids and text."""
    rows = _texts(docs, id_col, text_col)
    fields = [rows.schema["_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return arrow_map(rows, _digests(tokenizer_path), T.StructType(fields)).withColumnRenamed("_id", id_col)
