"""Public tokenizers over whole documents, piece by piece.

A document is cut where the tokenizer itself always cuts, and the ids of each distinct piece are kept, so the
tokenizer runs once per distinct piece instead of once per occurrence. The kept pieces are bounded.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from medloom.llm.rolling import ranges

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

KEPT_PIECES = 2_000_000
BATCH_CHARS = 1 << 22
#: A space before something that is no white space starts a piece of a byte-level tokenizer.
_SPACE = re.compile(r" (?=\S)")
_AWKWARD = re.compile(r" (?:\s|\Z)")


def public_path(name: str) -> str:
    """Where a vocabulary file of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def spaced_pieces(text: str) -> list[str]:
    """Cut before every space that precedes a non-space; all pieces but the first have lost that space."""
    return text.split(" ") if _AWKWARD.search(text) is None else _SPACE.split(text)


def batched(texts: Iterable[str], limit: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Neighbouring texts in lists of about ``limit`` characters."""
    group: list[str] = []
    size = 0
    for text in texts:
        if group and size + len(text) > limit:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text) + 64
    if group:
        yield group


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else the next free one from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {chr(b if b in printable else next(spare)): b for b in range(256)}


#: White space as the tokenizers' patterns have it.
_WHITE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_AWKWARD_ARROW = rf" ([{_WHITE}]|\z)"
_LINES = rf"\A[^{_WHITE}]+(\n[^{_WHITE}]+)+\z"
_TAILED = r"[A-Za-z0-9][,.]+\z"
_LATIN = r"\A[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+\z"


def _flags(column: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(column, pattern).to_numpy(zero_copy_only=False)


def _strings(column: pa.Array) -> list[str]:
    """A column as Python strings; ``to_pylist`` makes a scalar object of each first, at some ten times the cost."""
    return column.to_numpy(zero_copy_only=False).tolist()


class PieceEncoder:
    """Ids of texts, as little-endian unsigned 32-bit integers, from a file of the tokenizers library.

    Texts are cut and their pieces numbered as whole columns; Python sees each distinct piece of a column once.

    ``byte_level`` vocabularies keep white space: pieces but the first of a text start with their space. Others drop it, and
    fold case where their normaliser does; A-Z are then folded before looking a piece up. Commas and full stops after a
    letter or digit are words of their own to the tokenizer, and so is a single line feed between other characters, so pieces that
    hold them are put together from smaller ones. A piece of Latin-1 letters is one word, in normal form, and goes
    straight to the tokenizer's model. Texts that hold a special token's string go through the tokenizer whole, as the string takes part in cutting.

    Ids of pieces lie end to end in one array. When more than ``kept`` pieces are known, all are forgotten before the next column.
    """

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.byte_level = self.tokenizer.normalizer is None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = {b: c for c, b in byte_letters().items()}
        self.kept = kept
        self._forget()

    def _forget(self) -> None:
        #: The number of each piece, without a space before it and with one.
        self.numbers: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.ids = np.empty(1 << 12, np.uint32)
        self.ends = np.zeros(1 << 10, np.int64)  # of the ids of each piece; the first entry is no piece
        self.known = 0

    def _store(self, spaced: int, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first, used = self.known + 1, int(self.ends[self.known])
        while len(self.ids) < used + len(ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while len(self.ends) < first + len(pieces):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[used : used + len(ids)] = ids
        self.ends[first : first + len(pieces)] = used + np.cumsum(counts)
        self.numbers[spaced].update(zip(pieces, range(first, first + len(pieces)), strict=True))
        self.known += len(pieces)

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, end to end, and how many each has."""
        starts = self.ends[numbers - 1]
        counts = self.ends[numbers] - starts
        return self.ids[ranges(starts, counts)], counts

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts

    def _numbered(self, spaced: int, column: pa.Array) -> np.ndarray:
        """The number of each piece of a column; those not known yet are learned."""
        coded = column.dictionary_encode()
        names = coded.dictionary
        pieces = _strings(names)
        numbers = np.fromiter(map(self.numbers[spaced].get, pieces, repeat(0)), np.int64, len(pieces))
        new = np.flatnonzero(numbers == 0)
        if len(new):
            self._learn(spaced, names.take(pa.array(new)))
            learned = map(self.numbers[spaced].__getitem__, map(pieces.__getitem__, new.tolist()))
            numbers[new] = np.fromiter(learned, np.int64, len(new))
        return numbers[coded.indices.to_numpy()]

    def _learn(self, spaced: int, new: pa.Array) -> None:
        """Learn distinct pieces."""
        lines = _flags(new, _LINES) if self.byte_level else np.zeros(len(new), bool)
        latin = _flags(new, _LATIN)
        tailed = _flags(new, _TAILED) & ~lines
        part = lambda flags: new.take(pa.array(np.flatnonzero(flags)))
        self._learn_words(spaced, part(latin))
        rest = _strings(part(~(lines | tailed | latin)))
        for at in range(0, len(rest), 10_000):
            some = rest[at : at + 10_000]
            self._store(spaced, some, *self._whole([" " * spaced + p for p in some]))
        self._learn_tailed(spaced, part(tailed))
        self._learn_lines(spaced, part(lines))

    def _learn_words(self, spaced: int, words: pa.Array) -> None:
        if not len(words):
            return
        spelled = words if self.byte_level else pc.utf8_lower(words)
        head, tokenize = self.letters[32] * spaced, self.model.tokenize
        ids: list[int] = []
        counts = np.empty(len(words), np.int64)
        for i, w in enumerate(_strings(spelled)):
            if not w.isascii():
                w = w.encode().decode("latin-1").translate(self.letters)
            own = [t.id for t in tokenize(head + w)]
            ids += own
            counts[i] = len(own)
        self._store(spaced, _strings(words), np.array(ids, np.uint32), counts)

    def _learn_tailed(self, spaced: int, pieces: pa.Array) -> None:
        """Pieces that end in commas and full stops: a word and its tail."""
        if not len(pieces):
            return
        cores = pc.utf8_rtrim(pieces, ",.")
        tails = pc.struct_field(pc.extract_regex(pieces, r"(?P<tail>[,.]+)\z"), "tail")
        numbers = np.stack([self._numbered(spaced, cores), self._numbered(0, tails)], axis=1)
        ids, counts = self._ids_of(numbers.ravel())
        self._store(spaced, _strings(pieces), ids, counts.reshape(-1, 2).sum(axis=1))

    def _learn_lines(self, spaced: int, pieces: pa.Array) -> None:
        """Pieces of several lines: the lines, of which the first may have a space before it, and line feeds."""
        if not len(pieces):
            return
        lists = pc.split_pattern(pieces, "\n")
        flat, bounds = lists.flatten(), lists.offsets.to_numpy()
        first = np.zeros(len(flat), bool)
        first[bounds[:-1]] = True
        own = np.empty(len(flat), np.int64)
        for kind, flags in ((spaced, first), (0, ~first)):
            own[flags] = self._numbered(kind, flat.take(pa.array(np.flatnonzero(flags))))
        feed = self._numbered(0, pa.array(["\n"]))[0]
        at = 2 * np.arange(len(flat)) - np.repeat(np.arange(len(pieces)), np.diff(bounds))
        numbers = np.full(int(at[-1]) + 1, feed)
        numbers[at] = own
        ids, counts = self._ids_of(numbers)
        sums = np.append(0, np.cumsum(counts))
        ends = at[bounds[1:] - 1] + 1
        self._store(spaced, _strings(pieces), ids, np.diff(sums[np.append(0, ends)]))

    def _pieces(self, lists: pa.ListArray) -> list[bytes]:
        """The ids of texts from their pieces."""
        if not len(lists):
            return []
        flat, bounds = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        numbers = self._numbered(int(self.byte_level), flat)
        if self.byte_level:  # the first piece of a text has no space before it
            numbers[bounds[:-1]] = self._numbered(0, flat.take(pa.array(bounds[:-1])))
        ids, counts = self._ids_of(numbers)
        raw = memoryview(ids.astype("<u4", copy=False).tobytes())
        ends = (4 * np.append(0, np.cumsum(counts))[bounds]).tolist()
        return [bytes(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _column(self, column: pa.Array) -> list[bytes]:
        if self.known > self.kept:
            self._forget()
        folded = column if self.byte_level else pc.ascii_lower(column)
        special = np.zeros(len(column), bool)
        for s in self.special:
            special |= pc.match_substring(folded, s).to_numpy(zero_copy_only=False)
        awkward = _flags(column, _AWKWARD_ARROW) & ~special if self.byte_level else np.zeros(len(column), bool)
        if not self.byte_level:
            folded = pc.replace_substring(folded, "\n", " ")
        out: list[bytes] = [b""] * len(column)
        plain = np.flatnonzero(~(special | awkward))
        cut = pc.split_pattern(folded.take(pa.array(plain)), " ")
        odd = np.flatnonzero(awkward)
        split = pa.array([_SPACE.split(t) for t in _strings(column.take(pa.array(odd)))], pa.list_(pa.string()))
        for at, lists in ((plain, cut), (odd, split)):
            for i, own in zip(at.tolist(), self._pieces(lists), strict=True):
                out[i] = own
        for i in np.flatnonzero(special).tolist():
            out[i] = self._whole([column[i].as_py()])[0].astype("<u4").tobytes()
        return out

    def encode(self, texts: list[str] | pa.Array, chars: int = BATCH_CHARS) -> Iterator[bytes]:
        """The ids of each text, in order; texts of about ``chars`` bytes are cut and numbered at once, in some 15 times their size."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) if len(column) else np.zeros(0)
        first = 0
        while first < len(column):
            before = sizes[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(sizes, before + chars, side="right")))
            yield from self._column(column.slice(first, end - first))
            first = end


_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def encoder(path: str, kept: int = KEPT_PIECES) -> PieceEncoder:
    """The encoder of this worker process for a vocabulary file; it outlives the task, with the pieces it keeps."""
    if (path, kept) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, kept] = PieceEncoder(path, kept)
    return _ENCODERS[path, kept]
