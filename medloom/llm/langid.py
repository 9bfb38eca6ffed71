"""Language identification in two steps: the family, then the language among its relatives.

Both steps use one-versus-one linear support vector machines over hashed letter n-grams (2 to 4 bytes of lower-case
text, everything but letters a space), as shares of all n-grams of the text. They are trained by stochastic
subgradient steps on at most ``PER_LANGUAGE`` documents of each language, those of least hash, in one task that
returns the weights. Every text is scored whole, many texts at a time: a sum of weights for each machine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.mapping import arrow_map
from medloom.llm.rolling import chunks
from medloom.sources.shared import written

BITS = 14
ORDERS = (2, 3, 4)
SCALE = 200.0
PER_LANGUAGE = 1500
EPOCHS = 6
REGULARISATION = 1e-4
UNKNOWN = "und"

#: Families of common language codes. A code not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "celtic": ("ga", "cy", "gd", "br"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne"),
    "semitic": ("ar", "he", "mt", "am"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, language)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _letters(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end, four spaces after each, everything but letters a space; and where each starts."""
    gap = b" " * max(ORDERS)
    data = np.frombuffer(gap.join(texts) + gap, np.uint8)
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    lengths = np.array([len(t) + len(gap) for t in texts], np.int64)
    return np.where(letter, data, np.uint8(32)), np.cumsum(lengths) - lengths


def _grams(data: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the bucket of the n-gram at every place, and where it is not only spaces."""
    wide = data.astype(np.uint32)
    for order in ORDERS:
        n = len(data) - order + 1
        h = np.full(n, order, np.uint32)
        for k in range(order):
            h = (h ^ wide[k : k + n]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        yield h >> np.uint32(32 - BITS)


def counted(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and shares of each text's n-grams."""
    for text in texts:
        data, _ = _letters([text])
        total = np.zeros(1 << BITS, np.int64)
        for h in _grams(data):
            total += np.bincount(h, minlength=1 << BITS)
        at = np.flatnonzero(total)
        yield at.astype(np.uint16), (total[at] * (SCALE / max(1, total.sum()))).astype(np.float32)


def summed(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Scores of each text under each machine; ``weights`` has a row per machine, its last entry the bias."""
    data, starts = _letters(texts)
    out = np.zeros((len(texts), len(weights)))
    count = np.zeros(len(texts))
    lengths = np.diff(np.append(starts, len(data)))
    for h in _grams(data):
        for m, w in enumerate(weights):
            out[:, m] += np.add.reduceat(w[h], starts)
        lost = np.zeros(len(texts))
        lost[-1] = len(data) - len(h)
        count += lengths - lost
    return out * (SCALE / count)[:, None] + weights[:, -1].astype(np.float64)


def train_pair(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, seed: int = 0) -> np.ndarray:
    """Weights and bias of a linear support vector machine (hinge loss, averaged subgradient steps)."""
    w, total = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    share = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum())) * len(sign)
    rng, step, scale, taken = np.random.default_rng(seed), 0, 1.0, 0
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            step += 1
            rate = 1.0 / (REGULARISATION * (step + 1.0 / REGULARISATION))
            at, x = rows[i]
            margin = sign[i] * (scale * (w[at] @ x) + scale * w[-1])
            scale *= 1.0 - rate * REGULARISATION
            if margin < 1.0:
                w[at] += rate * share[i] * sign[i] / scale * x
                w[-1] += rate * share[i] * sign[i] / scale
        if epoch >= EPOCHS // 2:
            total += scale * w
            taken += 1
    return (total / max(1, taken)).astype(np.float32)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("_text").to_pylist(), strict=True):
            if text is None or not has_letter(text):
                continue
            at, x = next(counted([text.lower().encode()]))
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang]), "at": pa.array([at.tobytes()], pa.binary()), "x": pa.array([x.tobytes()], pa.binary())})


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    langs, rows = [], []
    for batch in batches:
        for lang, at, x in zip(*(batch.column(c).to_pylist() for c in ("lang", "at", "x")), strict=True):
            langs.append(lang)
            rows.append((np.frombuffer(at, np.uint16), np.frombuffer(x, np.float32)))
    own = np.array(langs, object)
    families = np.array([family_of(x) for x in langs], object)
    tasks = [("", a, b, families) for a, b in combinations(sorted(set(families)), 2)]
    for family in sorted(set(families)):
        tasks += [(family, a, b, own) for a, b in combinations(sorted({x for x, f in zip(langs, families, strict=True) if f == family}), 2)]
    for group, a, b, names in tasks:
        use = np.flatnonzero((names == a) | (names == b))
        w = train_pair([rows[i] for i in use], np.where(names[use] == a, 1.0, -1.0))
        yield pa.RecordBatch.from_pydict({"family": pa.array([group]), "a": pa.array([a]), "b": pa.array([b]), "w": pa.array([w.tobytes()], pa.binary())})
    for lang in sorted(set(langs)):
        yield pa.RecordBatch.from_pydict({"family": pa.array([family_of(lang)]), "a": pa.array([lang]), "b": pa.array([lang]), "w": pa.array([b""], pa.binary())})


class Model:
    """Machines by family; the empty family holds those between families."""

    def __init__(self, rows: list[tuple[str, str, str, bytes]]):
        machines = [r for r in rows if r[3]]
        self.weights = np.array([np.frombuffer(r[3], np.float32) for r in machines]).reshape(len(machines), (1 << BITS) + 1)
        self.languages: dict[str, list[str]] = {}
        for family, a, _, w in rows:
            if not w:
                self.languages.setdefault(family, []).append(a)
        self.languages = {f: sorted(x) for f, x in self.languages.items()}
        self.pairs: dict[str, list[tuple[int, int, int]]] = {}
        names = {"": sorted(self.languages)} | self.languages
        for m, (family, a, b, _) in enumerate(machines):
            self.pairs.setdefault(family, []).append((m, names[family].index(a), names[family].index(b)))

    def _choose(self, scores: np.ndarray, family: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of n classes, the one with most votes (ties: largest sum of margins), and the chance it beats the next."""
        votes, margins = np.zeros((len(scores), n)), np.zeros((len(scores), n))
        for m, a, b in self.pairs.get(family, ()):
            s = scores[:, m]
            votes[:, a] += s >= 0
            votes[:, b] += s < 0
            margins[:, a] += s
            margins[:, b] -= s
        rank = votes + 0.5 * np.tanh(margins / max(1, n))
        best = rank.argmax(axis=1)
        least = np.full(len(scores), np.inf)
        for m, a, b in self.pairs.get(family, ()):
            s = scores[:, m]
            least = np.where(best == a, np.minimum(least, s), np.where(best == b, np.minimum(least, -s), least))
        chance = 1.0 / (1.0 + np.exp(-np.clip(2.0 * least, -60, 60)))
        return best, chance

    def predict(self, texts: list[bytes], combine: np.ufunc = np.multiply) -> tuple[list[str], np.ndarray]:
        """The language of each text, and the chances of family and language combined."""
        scores = summed(texts, self.weights)
        families = sorted(self.languages)
        family, score = self._choose(scores, "", len(families))
        out = [""] * len(texts)
        for f, name in enumerate(families):
            here = np.flatnonzero(family == f)
            best, chance = self._choose(scores[here], name, len(self.languages[name]))
            score[here] = combine(score[here], chance)
            for i, b in zip(here.tolist(), best.tolist(), strict=True):
                out[i] = self.languages[name][b]
        return out, score


def _predict(rows: list[tuple[str, str, str, bytes]], combine: np.ufunc) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(rows)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            use = [i for i, t in enumerate(texts) if t is not None and has_letter(t)] if model.languages else []
            for first, group in chunks([texts[i].lower().encode() for i in use]):
                found, chance = model.predict(group, combine)
                for i, name, p in zip(use[first : first + len(group)], found, chance.tolist(), strict=True):
                    lang[i], score[i] = name, p
            kept = {n: batch.column(n) for n in batch.schema.names if n != "_text"}
            yield pa.RecordBatch.from_pydict(kept | {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)})

    return run


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a missing id."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(parts))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> list[tuple]:
    """Weights learned from rows with text and language; bounded by machines times 64 KB."""
    rows = labelled.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("_text"))
    rows = rows.filter("lang is not null and _text is not null and _id is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("_id"), "_id")
    drawn = rows.select("_id", "lang").distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_language).drop("place")
    sample = rows.join(written(drawn, "drawn"), ["_id", "lang"]).select("_id", "lang", "_text")
    features = written(arrow_map(sample.select("lang", "_text"), _featurise, "lang string, at binary, x binary"), "features")
    one = features.coalesce(1).sortWithinPartitions("lang", "at", "x")  # per_language rows of each language
    return [tuple(r) for r in arrow_map(one, _train, "family string, a string, b string, w binary").collect()]


def predict(docs: DataFrame, model: list[tuple], text_col: str = "text", keep: tuple[str, ...] = (), combine: np.ufunc = np.multiply) -> DataFrame:
    """The columns ``keep`` with lang_pred and score (0 to 1) of every text.

    The score is the product of the chances of family and language; ``np.minimum`` gives the weaker one. A text that is missing or has no letter is ``und`` with score 0, as is every text when nothing was learned.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return arrow_map(rows, _predict([(f, a, b, bytes(w)) for f, a, b, w in model], combine), schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, held: int = 2) -> DataFrame:
    """Per row: the id, held_out, lang_pred, score; learned from rows that are not held out.

    A row is held out when crc32 of its id modulo ``parts`` is ``held``. Rows without id are neither held out nor
    learned from. Rows that repeat an id and a language are drawn together. Other columns are ignored; an
    empty table gives an empty table.
    """
    side = fold(id_col, parts)
    model = train(docs.filter(side != held), id_col, text_col, lang_col)
    named = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.coalesce(side == held, F.lit(False)).alias("held_out"))
    return predict(named, model, "_text", ("_id", "held_out")).withColumnRenamed("_id", id_col)
