"""Token counts by rank-synchronous array merging.

A byte-pair tokenizer cuts a text into pre-tokens and, in each, merges the adjacent pair of lowest rank until
none is left. Here the distinct pre-tokens of a batch are one ragged numpy array (symbols, and the sequence
each belongs to). Every round looks up the ranks of all adjacent pairs, finds the lowest of each sequence and
merges that pair wherever it stands, in all sequences at once; the count of a pre-token is what survives.

Merging all places of a sequence's lowest pair in one round equals the queue of the usual algorithm, because
every merge makes a symbol that no other merge makes and pairs with it rank behind it. `MergeTable` checks
the first condition and refuses a vocabulary that breaks it.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_bytes, map_texts, resident

#: Fixed value: the pre-token pattern of byte-level vocabularies, as the file's ByteLevel step applies it.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_PAIR = np.int64(1) << 40
CACHED_PIECES = 1_000_000

#: A space before anything but white space starts a new pre-token wherever it stands, so a text may be cut there.
_PIECE = re.compile(r" (?=\S)")
_INNER_SPACE = re.compile(r" (?=\s)| \Z")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class MergeTable:
    """The merges of a byte-level vocabulary file as sorted arrays."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.width = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        if len(np.unique(made)) != len(made):
            raise ValueError("two merges make the same symbol: ranks cannot be applied in rounds")
        order = np.argsort(left * self.width + right)
        self.keys, self.ranks, self.made = (left * self.width + right)[order], order.astype(np.int64), made
        self.bytes = np.array([vocab[c] for c in byte_symbols()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_PAIR)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """The number of symbols each byte sequence ends up with."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        out = np.zeros(len(pieces), np.int64)
        symbols = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        seq = np.repeat(np.arange(len(pieces)), sizes)
        ranks = np.full(len(symbols), NO_PAIR)  # of the pair that starts here, as long as both symbols stand
        stale = np.arange(len(symbols))
        while len(symbols):
            stale = stale[stale < len(symbols) - 1]
            inside = seq[stale] == seq[stale + 1]
            ranks[stale[~inside]] = NO_PAIR
            stale = stale[inside]
            ranks[stale] = self.rank(symbols[stale], symbols[stale + 1])
            ranks[-1] = NO_PAIR
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            length = np.diff(np.r_[first, len(symbols)])
            lowest = np.minimum.reduceat(ranks, first)
            ended = lowest == NO_PAIR
            out[seq[first[ended]]] = length[ended]
            hits = np.flatnonzero((ranks == np.repeat(lowest, length)) & (ranks != NO_PAIR))
            if len(hits):  # of overlapping places (a run of one symbol) every second one merges, from the left
                run = np.flatnonzero(np.r_[True, np.diff(hits) != 1])
                hits = hits[(hits - np.repeat(hits[run], np.diff(np.r_[run, len(hits)]))) % 2 == 0]
                symbols[hits] = self.made[ranks[hits]]
            live = np.repeat(~ended, length)
            live[hits + 1] = False
            merged = (np.cumsum(live) - 1)[hits]
            symbols, seq, ranks = symbols[live], seq[live], ranks[live]
            stale = np.r_[merged, merged[merged > 0] - 1]
        return out


class TokenCounter:
    """Counts tokens of texts, keeping the counts of pieces it has met (at most CACHED_PIECES of them)."""

    def __init__(self, path: str):
        self.table, self.pattern, self.known = MergeTable(path), regex.compile(PRE_TOKENS), {}
        self.special = re.compile("|".join(map(re.escape, sorted(self.table.special, key=len, reverse=True))) or r"(?!)")

    def _pieces(self, text: str) -> list[str]:
        parts = _PIECE.split(text) if _INNER_SPACE.search(text) else text.split(" ")
        return [parts[0], *[" " + p for p in parts[1:]]]

    def learn(self, new: list[str]) -> None:
        letters = [p for p in new if p[1:].isalpha() and (p[0] == " " or p[0].isalpha())]  # one pre-token as they stand
        others = list(set(new).difference(letters))
        found = [self.pattern.findall(p) for p in others]
        distinct = list(set(letters).union(*found))
        count = dict(zip(distinct, self.table.counts([t.encode("utf-8") for t in distinct]).tolist()))
        self.known.update((p, count[p]) for p in letters)
        self.known.update(zip(others, (sum(map(count.__getitem__, tokens)) for tokens in found)))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a special string counts as one and cuts the text, as the library does."""
        extra, whole = [], []
        for text in texts:
            sections = self.special.split(text) if "<" in text and self.special.search(text) else [text]
            extra.append(len(sections) - 1)
            whole.append([p for s in sections for p in self._pieces(s)] if len(sections) > 1 else self._pieces(text))
        if len(self.known) > CACHED_PIECES:
            self.known.clear()
        self.learn(list(set().union(*whole) - self.known.keys()))
        return [n + sum(map(self.known.__getitem__, pieces)) for n, pieces in zip(extra, whole)]


def counter(path: str) -> TokenCounter:
    """One per Python worker, so that the tasks it runs share what was learnt."""
    return resident(("counter", path), lambda: TokenCounter(path))


def token_counts(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """Bytes and tokens of every whole text under a byte-level vocabulary file.

    One row per row of `docs`, repeated rows too: doc_id (null stays null), n_bytes and n_tokens (0 for a null
    or empty text), over_limit (n_tokens > limit). No shuffle; other columns of `docs` are not read. `tokenizer`
    is a path every executor has.
    """

    def make():
        known = counter(tokenizer)

        def step(texts: pa.Array):
            raw = as_bytes(texts)
            tokens = pa.array(known.counts([r.decode("utf-8", "replace") for r in raw]), pa.int64())
            return pa.array(map(len, raw), pa.int64()), tokens

        return step

    counted = map_texts(docs, {"doc_id": doc_id}, text, make, "n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
