"""Language identification with a string kernel.

A text is the set of its character n-grams (blended spectrum: every order up to `orders`, letters lower-cased,
everything else one space). The kernel of two texts is the number of n-grams present in both over the geometric
mean of their set sizes. Nyström landmarks, drawn from every language, give each text a finite kernel row;
one-versus-rest kernel ridge regression on those rows gives a score per language. Scoring multiplies a batch's
presence matrix with the landmarks' presence matrix and the result with the regression weights.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_texts, map_texts, resident, text_keys, whole_rows, without_texts

UNDETERMINED = "und"
MOST_LANGUAGES = 200
SLOTS = 1 << 18
BATCH_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def grams(texts: list[str], orders: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order the document numbers and codes of the n-grams of all texts; and which texts have a letter.

    A code is the n-gram itself: 21 bits per code point, so up to three of them fit 64 bits.
    """
    lowered = [" " + t.lower() + " " for t in texts]
    sizes = np.array([len(t) for t in lowered])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    doc = np.repeat(np.arange(len(texts)), sizes)
    is_letter = letters()[points]
    points = np.where(is_letter, points, 32).astype(np.uint64)
    kept = is_letter | np.r_[True, is_letter[:-1]] | np.r_[True, doc[1:] != doc[:-1]]  # one space after each word
    has_letter = np.zeros(len(texts), bool)
    has_letter[doc[is_letter]] = True
    points, doc = points[kept], doc[kept]
    found, codes = [(doc, points)], points
    for n in range(2, orders + 1):
        codes = (codes[:-1] << np.uint64(21)) | points[n - 1 :]
        inside = doc[: len(codes)] == doc[n - 1 :]
        found.append((doc[: len(codes)][inside], codes[inside]))
    return found, has_letter


@dataclass
class LanguageModel:
    """What scoring needs: the vocabulary (sorted codes per order), the landmarks' presence and sizes, the weights."""

    languages: list[str]
    vocabulary: list[np.ndarray]
    landmarks: np.ndarray
    weights: np.ndarray
    sharpness: float

    @property
    def orders(self) -> int:
        return len(self.vocabulary)

    def kernel(self, presence: np.ndarray) -> np.ndarray:
        """Rows: texts, columns: landmarks."""
        marks = self.landmarks.astype(np.float32)
        sizes = np.sqrt(np.maximum(presence.sum(1), 1))[:, None] * np.sqrt(np.maximum(marks.sum(1), 1))[None, :]
        return (presence @ marks.T) / sizes


class Presence:
    """Presence matrices over a vocabulary; a code is found in a table by its hash and compared whole."""

    def __init__(self, vocabulary: list[np.ndarray]):
        self.orders, self.size, self.tables, self.rest = len(vocabulary), sum(map(len, vocabulary)), [], []
        start = 0
        for codes in vocabulary:
            table, index = np.full(SLOTS, np.uint64(2**64 - 1)), np.zeros(SLOTS, np.int32)
            slot, number = self._slot(codes), np.arange(start, start + len(codes), dtype=np.int32)
            _, first = np.unique(slot, return_index=True)
            table[slot[first]], index[slot[first]] = codes[first], number[first]
            other = np.setdiff1d(np.arange(len(codes)), first)  # slot taken: looked up one by one
            self.tables.append((table, index))
            self.rest.append([(codes[i], number[i]) for i in other])
            start += len(codes)

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return ((codes * _MIX) >> np.uint64(46)).astype(np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found, has_letter = grams(texts, self.orders)
        out = np.zeros((len(texts), self.size), np.float32)
        for (doc, codes), (table, index), rest in zip(found, self.tables, self.rest):
            slot = self._slot(codes)
            hit = table[slot] == codes
            out[doc[hit], index[slot[hit]]] = 1
            for code, number in rest:
                out[doc[codes == code], number] = 1
        return out, has_letter


def _labelled_sample(docs: DataFrame, doc_id: str, text: str, lang: str, per_language: int) -> list[tuple[str, str]]:
    """(language, text) of at most about twice `per_language` rows of each language, by a hash of the key.

    The first pass counts languages, of which the MOST_LANGUAGES most frequent are learned; the second keeps the share
    of each that gives the wanted number. A key gives one text, the least, however many rows it has, so the sample
    never grows with the table.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(MOST_LANGUAGES).collect()}
    if not counts:
        return []
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.lit("language sample")), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, 2 * per_language / n) * (1 << 30)))])
    drawn = rows.select(F.col(lang).alias("lang"), F.col(doc_id).alias("id"), F.col(text).alias("text"), draw.alias("draw"))
    picked = drawn.filter(F.col("draw") < F.coalesce(share[F.col("lang")], F.lit(0))).groupBy("lang", "id", "draw").agg(F.min("text").alias("text")).collect()
    by_language: dict[str, list] = {}
    for r in sorted(picked, key=lambda r: (r.lang, r.draw, r.text)):
        by_language.setdefault(r.lang, []).append(r.text)
    return [(k, t) for k, texts in sorted(by_language.items()) for t in texts[:per_language]]


def fit_language(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 300,
    landmarks: int = 48,
    orders: int = 3,
    vocabulary: int = 6_000,
    ridge: float = 1e-2,
    sharpness: float = 3.0,
) -> LanguageModel | None:
    """Fit on a bounded sample of the rows with a text, a key and a language (`per_language` rows of each).

    `landmarks` texts of each language span the kernel space; the vocabulary is the `vocabulary` n-grams that
    come first by their place among those met in most sampled texts of a language, so every language has an equal say
    (met in at least two of its texts, if it has ten). None if there is no labelled row.
    """
    sample = _labelled_sample(docs, doc_id, text, lang, per_language)
    if not sample:
        return None
    languages = sorted({k for k, _ in sample})
    texts = [t for _, t in sample]
    each = [[np.unique(codes) for _, codes in grams([t], orders)[0]] for t in texts]
    place: dict[tuple[int, int], int] = {}  # of an n-gram among the most common ones of a language, the best of all languages
    for language in languages:
        own = [e for e, (k, _) in zip(each, sample) if k == language]
        met = [np.unique(np.concatenate([e[order] for e in own]), return_counts=True) for order in range(orders)]
        common = sorted((-int(n), order, int(code)) for order, found in enumerate(met) for code, n in zip(*found) if n > 1 or len(own) < 10)
        for at, (_, order, code) in enumerate(common):
            place[order, code] = min(at, place.get((order, code), at))
    first = sorted(place, key=lambda gram: (place[gram], gram))[:vocabulary]
    chosen = [np.array(sorted(code for o, code in first if o == order), np.uint64) for order in range(orders)]
    presence = Presence(chosen)
    rows = np.concatenate([presence(texts[at : at + 64])[0] for at in range(0, len(texts), 64)])
    labels = np.array([languages.index(k) for k, _ in sample])
    marks = np.concatenate([np.flatnonzero(labels == i)[:landmarks] for i in range(len(languages))])
    model = LanguageModel(languages, chosen, rows[marks].astype(bool), np.zeros((len(marks), len(languages))), sharpness)
    to_marks = model.kernel(rows).astype(np.float64)
    values, vectors = np.linalg.eigh(to_marks[marks])
    root = vectors * np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)  # Nyström map
    mapped = to_marks @ root
    targets = np.where(labels[:, None] == np.arange(len(languages))[None, :], 1.0, -1.0)
    balance = (len(labels) / (len(languages) * np.bincount(labels, minlength=len(languages))))[labels][:, None]
    solved = np.linalg.solve(mapped.T @ (balance * mapped) + ridge * len(labels) * np.eye(mapped.shape[1]) / 100, mapped.T @ (balance * targets))
    model.weights = root @ solved
    return model


def _scored(docs: DataFrame, keys: dict, text: str, model: LanguageModel | None, inside: str | None = None) -> DataFrame:
    def make():
        resident(None, None)
        presence = Presence(model.vocabulary) if model else None
        blank = presence([" "])[0][0] if model else None  # the gram of white space alone, which every text has

        def step(texts: pa.Array):
            values = as_texts(texts)
            if not model:
                return pa.array([UNDETERMINED] * len(values)), pa.array([0.0] * len(values)), pa.array([False] * len(values))
            rows, has_letter = presence(values)
            scores = model.sharpness * (model.kernel(rows) @ model.weights)
            shares = np.exp(scores - scores.max(1, keepdims=True))
            shares /= shares.sum(1, keepdims=True)
            best = shares.argmax(1)
            named = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), has_letter.tolist())]
            return pa.array(named), pa.array(np.where(has_letter, shares[np.arange(len(best)), best], 0.0).astype(np.float64)), pa.array((rows.sum(1) > rows @ blank) & has_letter)

        return step

    return map_texts(docs, keys, text, make, "lang_pred string, score double, known boolean", BATCH_BYTES // 4, inside)  # n-grams take some 100 bytes for each


def predict_language(docs: DataFrame, model: LanguageModel | None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and known (whether the model knows any of its n-grams with a letter) of every whole text, one row per row of `docs`.

    `und` with score 0 for a null text, a text without a letter, or no model. A text none of whose n-grams the
    model knows gets the first language with an even score. Ties go to the first language by name.
    """
    return _scored(docs, {"doc_id": doc_id}, text, model)


def with_language(docs: DataFrame, model: LanguageModel | None, *, text: str = "text") -> DataFrame:
    """`doc` (all columns of `docs` as one struct), lang_pred, score and known."""
    return _scored(docs, {"doc": whole_rows(docs)}, text, model, "doc")


def of_known_language(docs: DataFrame, model: LanguageModel | None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` in a language of the model, with all their columns. Dropped are null texts, texts without
    a letter, and texts with none of the n-grams the model knows (other scripts, say); without a model, all."""
    scored = _scored(docs, text_keys(doc_id, text), text, model)
    return without_texts(docs, scored.filter(~F.col("known")), doc_id=doc_id, text=text)
