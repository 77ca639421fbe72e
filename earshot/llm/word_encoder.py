"""Ids and numbers of ids of texts, by the tokenizers library, each distinct piece of text encoded once."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from earshot.llm.common import as_bytes, map_texts, resident

CACHED_PIECES = 2_000_000  # of about 40 bytes each
LONGEST_PIECE = 64
AT_ONCE = 2_000  # texts or pieces handed to the library


class Encoder:
    """Ids of texts, by the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def lists(self, texts: list[bytes]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [e.ids for e in found]

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for a in range(0, len(texts), AT_ONCE):  # the library's results are far larger than the ids
            lists = self.lists(texts[a : a + AT_ONCE])
            sizes.append(np.array([len(x) for x in lists], np.int64))
            ids.append(np.fromiter((i for x in lists for i in x), np.int32, int(sizes[-1].sum())))
        return np.concatenate(ids), np.concatenate(sizes)


class WordEncoder(Encoder):
    """For a tokenizer that drops white space, lower-cases, and never joins letters, digits and other symbols.

    The ids of a text are then those of its pieces one after another. Pieces are cut with numpy: at white space,
    and between ASCII letters, digits and symbols; not beside an apostrophe (contractions are one token) nor
    beside a byte above 127 (it may belong to what stands there). A capital is lowered unless such a byte follows.
    The library encodes each distinct piece once per worker; a text that holds a special string, and pieces of
    over LONGEST_PIECE bytes, are encoded as they stand.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        kinds = np.full(256, 3, np.uint8)
        for kind, chars in ((0, b" \t\n\x0b\f\r"), (1, bytes(range(65, 91)) + bytes(range(97, 123))), (2, b"0123456789"), (4, bytes(range(128, 256)) + b"'")):
            kinds[list(chars)] = kind
        rng = np.random.default_rng(1)
        self.kinds, self.values = kinds, rng.integers(1, 2**63, (2, 256), dtype=np.uint64)
        with np.errstate(over="ignore"):
            odd = rng.integers(1, 2**63, (2, 1), dtype=np.uint64) | np.uint64(1)
            self.powers = np.cumprod(np.repeat(odd, LONGEST_PIECE, 1), axis=1, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        """Known pieces are two hashes and a number, sorted by the first hash; numbers count from 0 in the store."""
        self.hashes, self.checks, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.store, self.ends, self.used, self.count = np.zeros(1 << 20, np.int32), np.zeros(1 << 18, np.int64), 0, 0

    def _learn(self, pieces: list[bytes]) -> None:
        """Append the ids of new pieces to the store."""
        ids, sizes = super().ids(pieces)
        n = self.count
        while self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while n + len(pieces) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.store[self.used : self.used + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(pieces)] = self.used + np.cumsum(sizes)
        self.used += len(ids)
        self.count += len(pieces)

    def _numbers(self, hashes: np.ndarray, checks: np.ndarray, lasting: np.ndarray, spell) -> np.ndarray:
        """The numbers of distinct pieces; those not known are spelt, encoded and, if `lasting`, remembered."""
        if self.count + len(hashes) > CACHED_PIECES:
            self._forget()
        at = np.searchsorted(self.hashes, hashes)
        near = np.minimum(at, max(0, len(self.hashes) - 1))
        taken = self.hashes[near] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        found = taken & (self.checks[near] == checks) if len(self.hashes) else taken
        out = np.empty(len(hashes), np.int64)
        out[found] = self.numbers[near[found]]
        new = np.flatnonzero(~found)
        out[new] = self.count + np.arange(len(new))
        self._learn(spell(new))
        kept = new[(lasting & ~taken)[new]]
        kept = kept[np.r_[True, hashes[kept][1:] != hashes[kept][:-1]]] if len(kept) else kept
        for name, values in (("hashes", hashes), ("checks", checks), ("numbers", out)):
            setattr(self, name, np.insert(getattr(self, name), at[kept], values[kept]))
        return out

    def _pieces(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For every piece of the batch its number in the store, and the number of pieces of each text."""
        joined = b"\n".join(texts) + b"\n"
        chars = np.frombuffer(joined, np.uint8)
        kind = self.kinds[chars]
        lower = (chars >= 65) & (chars <= 90)
        lower[:-1] &= chars[1:] < 128
        chars = chars + np.where(lower, np.uint8(32), np.uint8(0))
        before = np.r_[np.uint8(0), kind[:-1]]
        cut = (before == 0) | ((kind != before) & (kind < 4) & (before < 4))
        if any(s in joined for s in self.special):
            cut = before == 0
        start = np.flatnonzero((kind != 0) & cut)
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        opened = np.zeros(len(chars) + 1, bool)
        opened[start] = True
        stop = (opened[1:] | (np.r_[kind[1:], np.uint8(0)] == 0)) & (kind != 0)
        size = np.flatnonzero(stop) + 1 - start
        text_end = np.cumsum([len(t) + 1 for t in texts])
        per_text = np.diff(np.r_[0, np.searchsorted(start, text_end)])

        inside = np.flatnonzero(kind != 0)
        first = np.r_[0, np.cumsum(size)[:-1]]
        place = np.minimum(np.arange(len(inside)) - np.repeat(first, size), LONGEST_PIECE - 1)
        letters = chars[inside]
        with np.errstate(over="ignore"):
            one, checks = (np.add.reduceat(self.values[k][letters] * self.powers[k][place], first) for k in (0, 1))
            hashes = (one ^ (checks >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15) + checks
        long = size > LONGEST_PIECE  # not hashed whole: each stands for itself
        hashes, checks = np.where(long, start.astype(np.uint64), hashes), np.where(long, ~start.astype(np.uint64), checks)
        _, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        if (checks != checks[example][which]).any():  # two pieces with one first hash
            _, example, which = np.unique(np.stack([hashes, checks], 1), axis=0, return_index=True, return_inverse=True)
        whole = chars.tobytes()
        spell = lambda rows: [whole[a : a + n] for a, n in zip(start[example[rows]].tolist(), size[example[rows]].tolist())]
        return self._numbers(hashes[example], checks[example], ~long[example], spell)[which], per_text

    def sizes(self, texts: list[bytes]) -> np.ndarray:
        """The number of ids of each text."""
        piece, per_text = self._pieces(texts)
        return np.diff(np.r_[0, np.r_[0, np.cumsum(self.ends[piece + 1] - self.ends[piece])][np.cumsum(per_text)]])

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        piece, per_text = self._pieces(texts)
        start, length = self.ends[piece], self.ends[piece + 1] - self.ends[piece]
        after = np.cumsum(length)
        where = np.arange(int(after[-1]) if len(after) else 0) + np.repeat(start - (after - length), length)
        return self.store[where], np.diff(np.r_[0, np.r_[0, after][np.cumsum(per_text)]])


def encoder(path: str, by_word: bool) -> Encoder:
    """One per Python worker, so that the tasks it runs share the pieces they met."""
    return resident(("encoder", path, by_word), lambda: WordEncoder(path) if by_word else Encoder(path))


def token_lengths(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", extra: int = 0) -> DataFrame:
    """doc_id and n_tokens of every whole text under a tokenizer that may be applied by word, plus `extra` ids
    for its end; null counts as empty. One row per row of `docs`."""

    def make():
        known = encoder(tokenizer, True)
        return lambda texts: (pa.array(known.sizes(as_bytes(texts)) + extra, pa.int64()),)

    return map_texts(docs, {"doc_id": doc_id}, text, make, "n_tokens long", max_bytes=256 << 10)  # cutting takes some 80 bytes for each
