"""Hashes of every stretch of a token sequence, and content-chosen anchors, as whole-array operations.

Many documents are laid end to end in one array, so the cost per document is small. Tokens are either bytes or
words; both are represented by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

CHUNK_BYTES = 1 << 19
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a one-to-one mapping)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


BYTE_TOKENS = mix(np.arange(1, 257, dtype=U) * U(0xA0761D6478BD642F))
SECOND = U(0x5851F42D4C957F2D)
BYTE_TOKENS_2 = mix(BYTE_TOKENS + SECOND)


@lru_cache(maxsize=4)
def _power_table(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    m = _MULTIPLIERS[which]
    up, down = np.full(size, m, U), np.full(size, pow(m, -1, 1 << 64), U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd multiplier and of its inverse, modulo 2**64."""
    room = 1 << max(20, int(size).bit_length())
    up, down = _power_table(which, room)
    return up[:size], down[:size]


def prefix_sums(tokens: np.ndarray, which: int = 0) -> np.ndarray:
    """Sums from which the hash of any stretch follows by one subtraction; one entry longer than ``tokens``."""
    out = np.zeros(len(tokens) + 1, U)
    np.cumsum(tokens * powers(which, len(tokens))[0], out=out[1:])
    return out


def stretch_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of tokens[start:end] for arrays of starts and ends, independent of where the stretch lies."""
    return (sums[end] - sums[start]) * powers(which, len(sums))[1][start]


def gram_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Mixed hash of every run of ``size`` tokens."""
    if len(tokens) < size:
        return np.empty(0, U)
    sums = prefix_sums(tokens)
    count = len(tokens) - size + 1
    return mix((sums[size:] - sums[:count]) * powers(0, count)[1])


def sliding_min(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` neighbours."""
    if len(values) < span:
        return np.empty(0, values.dtype)
    out, have = values, 1
    while have * 2 <= span:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = span - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers start, start+1, ... of each of the given ranges, one range after the other."""
    total = int(counts.sum())
    offsets = np.cumsum(counts) - counts
    return np.repeat(starts - offsets, counts) + np.arange(total)


def anchored_runs(
    tokens: np.ndarray, second: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, ...]:
    """Cut the windows of every document into runs that share an anchor.

    A window is ``window`` consecutive tokens of one document; documents are tokens[starts[i]:ends[i]]. The anchor
    of a window is the leftmost gram (``gram`` tokens) of least hash inside it, so it depends on the window's
    content only: equal windows have equal grams at the same place. Neighbouring windows mostly share their
    anchor. Returns document, first and last window start, anchor position, hash of the anchor's gram, and a
    second, independent hash of everything the run covers.
    """
    empty = np.empty(0, np.int64)
    keep = np.flatnonzero(ends - starts >= window)
    if not len(keep):
        return empty, empty, empty, empty, np.empty(0, U), np.empty(0, U)
    span = window - gram + 1
    grams = gram_hashes(tokens, gram)
    counts = (ends - starts - window + 1)[keep]
    at = ranges(starts[keep], counts)
    least = sliding_min(grams, span)[at]
    new = np.ones(len(at), bool)
    joined = at[1:] == at[:-1] + 1
    new[1:] = (least[1:] != least[:-1]) | ~joined
    head = np.flatnonzero(new)
    p0, p1, value = at[head], at[np.append(head[1:], len(at)) - 1], least[head]
    anchor = p0 + span - 1
    sunk = np.zeros(len(head), bool)  # a lower gram has just entered on the right: it is the anchor
    inner = head[head > 0]
    sunk[head > 0] = joined[inner - 1] & (least[inner] < least[inner - 1])
    look = np.flatnonzero(~sunk)
    step = max(1, (1 << 20) // span)
    offsets = np.arange(span)
    for i in range(0, len(look), step):
        part = look[i : i + step]
        anchor[part] = p0[part] + np.argmax(grams[p0[part][:, None] + offsets] == value[part][:, None], axis=1)
    late = np.flatnonzero(p1 > anchor)
    if len(late):  # the same least gram occurs again: later windows of the run have a later anchor
        pieces = [(np.delete(p0, late), np.delete(p1, late), np.delete(anchor, late), np.delete(value, late))]
        for i in late:
            here = p0[i] + np.flatnonzero(grams[p0[i] : p1[i] + span] == value[i])
            windows = np.arange(p0[i], p1[i] + 1)
            own = here[np.searchsorted(here, windows)]
            cut = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            last = np.append(cut[1:], len(own)) - 1
            pieces.append((windows[cut], windows[last], own[cut], np.full(len(cut), value[i], U)))
        p0, p1, anchor, value = (np.concatenate(x) for x in zip(*pieces, strict=True))
    sums = prefix_sums(second, 1)
    whole = stretch_hash(sums, p0, p1 + window, 1)
    shape = (anchor - p0).astype(U) * U(0x9FB21C651E98DF25) + (p1 - p0).astype(U) * U(0xE7037ED1A0B428DB)
    return np.searchsorted(starts, p0, side="right") - 1, p0, p1, anchor, value, mix(whole + shape)


def chunks(texts: Iterable[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts in groups of about ``limit`` bytes, each with the number of its first text."""
    group: list[bytes] = []
    first = size = 0
    for i, text in enumerate(texts):
        if group and size + len(text) > limit:
            yield first, group
            group, first, size = [], i, 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield first, group


def is_space(data: np.ndarray) -> np.ndarray:
    """Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def byte_layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end as bytes, with the start and end of each."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return data, np.append(0, ends[:-1]).astype(np.int64), ends


def word_layout(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, ...]:
    """The words of several texts: word hashes, first and last word of each text, and where each word's bytes lie.

    Returns hashes, text starts and ends (word numbers), the joined bytes, word starts and word ends (bytes).
    ``lower`` folds A-Z only.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    space = is_space(data)
    edge = np.diff(space.view(np.int8), prepend=np.int8(1))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(end) and len(begin) and end[0] < begin[0]:
        end = end[1:]
    end = end[: len(begin)]
    sums = prefix_sums(BYTE_TOKENS[data])
    hashes = mix(stretch_hash(sums, begin, end) + (end - begin).astype(U))
    bounds = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    ends = np.searchsorted(begin, bounds)
    return hashes, np.append(0, ends[:-1]).astype(np.int64), ends.astype(np.int64), data, begin, end
