"""Benchmark decontamination by edit distance.

Texts and benchmark items are sequences of words. An item leaks into a document if some passage of it is within
`max_edit` of the item's length in word edits. The search, per document and without a shuffle:

1. A gate that loses nothing: k edits break at most 2k of the word pairs of an item of n words. So the document
   must hold all but 2k of the item's distinct pairs, and a passage of n+k words n-1-2k of its pairs.
2. CGK embedding of the item-sized windows that remain: a random walk copies the words to three times the length,
   stepping on by a random bit of (step, word). Few edits give a small Hamming distance.
3. Bit-sampling LSH: tables of sampled places of several embeddings; a window and an item of its size meet if one
   table agrees. The number of tables is what reaches the target recall on edited copies of the items themselves; an
   item whose own copy the tables would find with less than that recall meets every window the gate leaves it.
4. Exact edit distance for the pairs that met; overlapping windows of one item are one run of text.

The benchmark is read in blocks of `block_items`, so what is sent to the tasks has a fixed bound however many
items there are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_texts, resident, text_batches, text_keys, trim, without_texts

WORD = re.compile(r"\w+")
UNKNOWN, PAD = -1, -2
EDIT, FAR = 1 << 32, 1 << 62
CELLS = 1 << 22  # of an array in a task, 32 MB
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def embed(rows: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """CGK embedding of each row (padded with PAD) to three times the width; each walks on its own words."""
    n, width = rows.shape
    out = np.full((n, 3 * width), PAD, np.int64)
    at, every = np.zeros(n, np.int64), np.arange(n)
    padded = np.concatenate([rows, np.full((n, 1), PAD, np.int64)], 1)
    for step in range(3 * width):
        word = padded[every, at]
        out[:, step] = word
        bit = mix(word.astype(np.uint64) * _B + np.uint64(seed * 1_000_003 + step)) >> np.uint64(63)
        at = np.minimum(at + bit.astype(np.int64), sizes)
    return out


def closest_passages(items: np.ndarray, texts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the passage of the text closest to the item among those that begin at a marked place: word edits,
    first word, number of words. Of equally close ones the first, then the shortest.

    Items have one width, texts are padded to one; `starts` has a column more than them. All beginnings share one
    table of edits, so a run of overlapping windows costs its length times the item's, however many begin in it.
    """
    at = np.arange(texts.shape[1] + 1)
    row = np.where(starts, at, FAR)  # edits and the beginning in one number: the least is the closest and first
    row = np.minimum.accumulate(row - at * EDIT, axis=1) + at * EDIT
    for i in range(items.shape[1]):
        step = np.empty_like(row)
        step[:, 0] = row[:, 0] + EDIT
        step[:, 1:] = np.minimum(row[:, 1:] + EDIT, row[:, :-1] + (texts != items[:, i : i + 1]) * EDIT)
        row = np.minimum.accumulate(step - at * EDIT, axis=1) + at * EDIT
    best, first = row.min(1), row.min(1) % EDIT
    return best // EDIT, first, row.argmin(1) - first


@dataclass
class BenchmarkBlock:
    """A bounded number of items, with the tables that find them."""

    ids: list
    items: list[np.ndarray]
    vocabulary: dict[str, int]
    grams: np.ndarray  # the distinct word pairs of all items, sorted
    holders: np.ndarray  # the items that hold each, one list after another
    holder_ends: np.ndarray
    item_grams: list[np.ndarray]  # by number, per item
    max_edit: float
    sampled: np.ndarray  # tables x places, as shares of the embedding's length
    seeds: list[int]  # the embedding of each table
    exact: np.ndarray  # per item: the tables do not reach the target recall
    keys: np.ndarray
    owners: np.ndarray

    def edits(self, n: np.ndarray) -> np.ndarray:
        return np.floor(n * self.max_edit + 1e-9).astype(np.int64)

    def signatures(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """rows x tables; sequences of different sizes never share one."""
        out = np.empty((len(rows), len(self.seeds)), np.uint64)
        for seed in sorted(set(self.seeds)):
            embedded = embed(rows, sizes, seed)
            for t in [t for t, s in enumerate(self.seeds) if s == seed]:
                places = (self.sampled[t][None, :] * 3 * sizes[:, None]).astype(np.int64)
                sig = mix(sizes.astype(np.uint64) * _A + np.uint64(t))
                for p in places.T:
                    sig = mix(sig ^ (embedded[np.arange(len(rows)), p].astype(np.uint64) * _B))
                out[:, t] = sig
        return out


def _padded(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.full((len(rows), width), PAD, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _edited(item: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    out = item.tolist()
    for _ in range(k):
        kind, at = rng.integers(3), int(rng.integers(max(1, len(out))))
        if kind == 0 and len(out) > 1:
            del out[at]
        elif kind == 1:
            out.insert(at, UNKNOWN)
        elif out:
            out[at] = UNKNOWN
    return np.array(out[: len(item)], np.int64)


def _by_cells(widths: np.ndarray, cells: int):
    """Row numbers in parts whose padded array has at most `cells` cells, or one row; narrow rows first."""
    order = np.argsort(widths, kind="stable")
    a = 0
    while a < len(order):
        wide = widths[order[a:]]
        fits = int(np.searchsorted(wide * np.arange(1, len(wide) + 1), cells, "right"))
        yield order[a : a + max(1, fits)]
        a += max(1, fits)


def _agreement(items: list[np.ndarray], copies: list[np.ndarray], embeddings: int) -> np.ndarray:
    """embeddings x items: the share of an item's embedding that its edited copy has alike."""
    sizes, changed = np.array([len(c) for c in items]), np.array([len(c) for c in copies])
    out = np.empty((embeddings, len(items)))
    for part in _by_cells(3 * sizes, CELLS):
        n, width = sizes[part], int(sizes[part].max())
        plain, other = _padded([items[x] for x in part.tolist()], width), _padded([copies[x] for x in part.tolist()], width)
        inside = np.arange(3 * width)[None, :] < 3 * n[:, None]
        for seed in range(embeddings):
            same = (embed(plain, n, seed) == embed(other, np.minimum(n, changed[part]), seed)) & inside
            out[seed, part] = same.sum(1) / (3 * n)
    return out


def build_block(
    items: list[tuple], max_edit: float, target_recall: float, *, places: int = 3, embeddings: int = 4, most_tables: int = 128
) -> BenchmarkBlock | None:
    """Tables for (item id, text) pairs; items without words are left out (nothing can match them).

    A copy of each item with the most edits allowed is embedded; the tables needed are the fewest for which the
    expected share of copies found reaches `target_recall`, at most `most_tables`. Items whose own copy stays
    below the target are marked `exact`.
    """
    split = [(i, words(t or "")) for i, t in items]
    split = [(i, w) for i, w in split if w]
    if not split:
        return None
    vocabulary = {w: n for n, w in enumerate(dict.fromkeys(w for _, ws in split for w in ws))}
    coded = [np.array([vocabulary[w] for w in ws], np.int64) for _, ws in split]
    codes = [_gram_codes(c, len(vocabulary), True) if len(c) == 1 else _gram_codes(c, len(vocabulary), False) for c in coded]
    grams = np.unique(np.concatenate(codes))
    item_grams = [np.unique(np.searchsorted(grams, c)) for c in codes]
    held = np.concatenate(item_grams)
    holders = np.repeat(np.arange(len(coded)), [len(g) for g in item_grams])[np.argsort(held, kind="stable")]
    holder_ends = np.cumsum(np.bincount(held, minlength=len(grams)))
    rng = np.random.default_rng(20)
    copies = [_edited(c, int(len(c) * max_edit + 1e-9), rng) for c in coded]
    miss = 1 - _agreement(coded, copies, embeddings) ** places  # of one table, per embedding and copy
    most = max(1, most_tables // embeddings)
    rounds = next((r for r in range(1, most) if (1 - (miss**r).prod(0)).mean() >= target_recall), most)
    exact = 1 - (miss**rounds).prod(0) < target_recall
    seeds = [s for s in range(embeddings) for _ in range(rounds)]
    block = BenchmarkBlock([i for i, _ in split], coded, vocabulary, grams, holders, holder_ends, item_grams, max_edit, rng.random((len(seeds), places)), seeds, exact, None, None)
    sizes = np.array([len(c) for c in coded])
    sig = np.empty((len(coded), len(seeds)), np.uint64)
    for part in _by_cells(3 * sizes, CELLS):
        sig[part] = block.signatures(_padded([coded[x] for x in part.tolist()], int(sizes[part].max())), sizes[part])
    keys, owners = sig.ravel(), np.repeat(np.arange(len(coded)), len(seeds))
    order = np.argsort(keys, kind="stable")
    block.keys, block.owners = keys[order], owners[order]
    return block


def _gram_codes(words_: np.ndarray, vocabulary: int, single: bool) -> np.ndarray:
    """Codes of the word pairs of a sequence, or of its single words; -1 where a word is unknown."""
    if single:
        return np.where(words_ >= 0, vocabulary * vocabulary + words_, -1)
    left, right = words_[:-1], words_[1:]
    return np.where((left >= 0) & (right >= 0), left * vocabulary + right, -1)


def _windows(block: BenchmarkBlock, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, item) of every item-sized window that the gate leaves."""
    v, many = len(block.vocabulary), len(block.items)
    sizes = np.array([len(c) for c in block.items])
    k = block.edits(sizes)
    distinct = np.array([len(g) for g in block.item_grams])
    in_doc, in_window = np.maximum(1, distinct - 2 * k), np.maximum(1, sizes - 1 - 2 * k)
    kinds = ([False] if (sizes > 1).any() else []) + ([True] if (sizes == 1).any() else [])
    found = []
    for d, doc in enumerate(docs):
        places = []  # the gram that starts at each word, per kind of gram
        for single in kinds:
            codes = _gram_codes(doc, v, single)
            at = np.minimum(np.searchsorted(block.grams, codes), len(block.grams) - 1)
            places.append(np.where(block.grams[at] == codes, at, -1))
        met = np.unique(np.concatenate(places)) if places else np.zeros(0, np.int64)
        met = met[met >= 0]
        if not len(met):
            continue
        ends = block.holder_ends[met]
        lengths = ends - np.where(met > 0, block.holder_ends[met - 1], 0)
        offsets = np.arange(lengths.sum()) + np.repeat(ends - np.cumsum(lengths), lengths)
        shared = np.bincount(block.holders[offsets], minlength=many)
        for i in np.flatnonzero(shared >= in_doc).tolist():
            n, kk = int(sizes[i]), int(k[i])
            if len(doc) < n - kk:
                continue
            own = np.zeros(len(block.grams) + 1, bool)  # the last stands for no gram
            own[block.item_grams[i]] = True
            running = np.zeros(len(doc) + 1, np.int64)
            hits = own[places[kinds.index(n == 1)]]
            running[1 : len(hits) + 1] = np.cumsum(hits)
            running[len(hits) + 1 :] = running[len(hits)]
            starts = np.arange(len(doc) - (n - kk) + 1)
            grams_in = 1 if n == 1 else n + kk - 1
            ok = starts[running[np.minimum(starts + grams_in, len(doc))] - running[starts] >= in_window[i]]
            found.append(np.stack([np.full(len(ok), d), ok, np.full(len(ok), i)]))
    return tuple(np.concatenate(found, 1)) if found else (np.array([], np.int64),) * 3


def _met(block: BenchmarkBlock, docs: list[np.ndarray], doc: np.ndarray, start: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows that agree with their item in a table, and all windows of exact items, by document, item, first word."""
    sizes = np.array([len(c) for c in block.items])
    keep = block.exact[wanted]
    asked = np.flatnonzero(~keep)
    for part in _by_cells(3 * sizes[wanted[asked]], CELLS):
        rows = asked[part]
        n = sizes[wanted[rows]]
        passages = [docs[x][y : y + m] for x, y, m in zip(doc[rows].tolist(), start[rows].tolist(), n.tolist())]
        sig = block.signatures(_padded(passages, int(n.max())), n)
        low, high = np.searchsorted(block.keys, sig, "left"), np.searchsorted(block.keys, sig, "right")
        met = (high - low).ravel()
        window = np.repeat(np.repeat(np.arange(len(rows)), sig.shape[1]), met)
        item = block.owners[np.repeat(low.ravel(), met) + np.arange(met.sum()) - np.repeat(np.cumsum(met) - met, met)]
        keep[rows[window[item == wanted[rows][window]]]] = True  # an item that the gate excluded cannot match
    order = np.flatnonzero(keep)
    order = order[np.lexsort((start[order], wanted[order], doc[order]))]
    return doc[order], start[order], wanted[order]


def _runs(doc: np.ndarray, start: np.ndarray, wanted: np.ndarray, sizes: np.ndarray, edits: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows of one document and item that overlap, as (document, item, first window, end of windows)."""
    if not len(doc):
        return (np.zeros(0, np.int64),) * 4
    new = (np.diff(doc) != 0) | (np.diff(wanted) != 0) | (np.diff(start) >= (sizes + edits)[wanted[1:]])
    begins = np.concatenate([[0], np.flatnonzero(new) + 1])
    return doc[begins], wanted[begins], begins, np.append(begins[1:], len(doc))


def find_leaks(block: BenchmarkBlock, docs: list[list[str]]) -> list[tuple[int, int, int, int, int]]:
    """(document, item, edits, first word, words) of the closest passage of each document and item that match;
    of equally close ones the first."""
    coded = [np.fromiter((block.vocabulary.get(w, UNKNOWN) for w in ws), np.int64, len(ws)) for ws in docs]
    doc, start, wanted = _met(block, coded, *_windows(block, coded))
    sizes = np.array([len(c) for c in block.items])
    d, i, begins, ends = _runs(doc, start, wanted, sizes, block.edits(sizes))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for m in np.unique(sizes[i]).tolist():
        k, same = int(block.edits(np.array(m))), np.flatnonzero(sizes[i] == m)
        low = start[begins[same]]
        high = np.minimum(start[ends[same] - 1] + m + k, [len(coded[x]) for x in d[same].tolist()])
        for part in _by_cells(high - low + 1, CELLS // 16):
            run = same[part]
            texts = _padded([coded[x][y:z] for x, y, z in zip(d[run].tolist(), low[part].tolist(), high[part].tolist())], int((high - low)[part].max()))
            marked = np.zeros((len(run), texts.shape[1] + 1), bool)
            for r, (x, y, z) in enumerate(zip(begins[run].tolist(), ends[run].tolist(), low[part].tolist())):
                marked[r, start[x:y] - z] = True
            distance, first, used = closest_passages(np.stack([block.items[x] for x in i[run]]), texts, marked)
            for j in np.flatnonzero(distance <= k).tolist():
                key, value = (int(d[run[j]]), int(i[run[j]])), (int(distance[j]), int(first[j] + low[part[j]]), int(used[j]))
                if key not in best or value < best[key]:
                    best[key] = value
    return [(d, i, *v) for (d, i), v in sorted(best.items())]


def blocks(benchmark: DataFrame, item_id: str, text: str, max_edit: float, target_recall: float, block_items: int):
    """The benchmark in blocks of at most `block_items` items, in order of id."""
    rows = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")).orderBy("id", "text")
    part: list[tuple] = []
    for r in rows.toLocalIterator():
        part.append((r.id, r.text))
        if len(part) == block_items:
            yield build_block(part, max_edit, target_recall)
            part = []
    if part:
        yield build_block(part, max_edit, target_recall)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_edit: float = 0.2,
    target_recall: float = 0.99,
    block_items: int = 5_000,
) -> DataFrame:
    """The benchmark items found in documents, by word edits over the whole text.

    One row per row of `docs` and item found: doc_id, item_id, edits, item_words, similarity (1 - edits / item
    words), first_word and n_words of the closest passage (the first of equals). Words are `\\w+`, lower-cased.
    Null or empty texts and items match nothing; an item of up to four words must stand word for word. Repeated
    rows or items each give their own rows; empty tables give none.
    """
    keys = [docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()]
    schema = f"doc_id {keys[0]}, item_id {keys[1]}, edits int, item_words int, similarity double, first_word int, n_words int"
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = [rows.mapInArrow(_leak_step(b, keys[0], keys[1]), schema) for b in blocks(benchmark, item_id, item_text, max_edit, target_recall, block_items) if b]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def _leak_step(block: BenchmarkBlock, doc_type: str, item_type: str):
    def run(batches):
        resident(None, None)
        ids = pa.array(block.ids)
        for batch in text_batches(batches, 1):
            hits = find_leaks(block, [words(t) for t in as_texts(batch.column(1))])
            d, i, e, s, n = (list(x) for x in zip(*hits)) if hits else ([], [], [], [], [])
            size = [len(block.items[x]) for x in i]
            share = [1 - a / b for a, b in zip(e, size)]
            small = [pa.array(x, pa.int32()) for x in (e, size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(d, pa.int64())), ids.take(pa.array(i, pa.int64())), *small, pa.array(share, pa.float64()), pa.array(s, pa.int32()), pa.array(n, pa.int32())],
                names=["doc_id", "item_id", "edits", "item_words", "similarity", "first_word", "n_words"],
            )

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  max_edit: float = 0.2, target_recall: float = 0.99, block_items: int = 5_000) -> DataFrame:
    """The rows of `docs` in which no item is found, with all their columns; rules as in `leaks`. A row is dropped
    by its key and text, so keys may repeat or be null."""
    rows = docs.select(*[c.alias(n) for n, c in text_keys(doc_id, text).items()], F.col(text).alias("text"))
    schema = rows.select("_key", "_told").schema
    found = [rows.mapInArrow(_found_step(b), schema) for b in blocks(benchmark, item_id, item_text, max_edit, target_recall, block_items) if b]
    return without_texts(docs, reduce(DataFrame.unionByName, found), doc_id=doc_id, text=text) if found else docs


def _found_step(block: BenchmarkBlock):
    def run(batches):
        resident(None, None)
        for batch in text_batches(batches, 2):
            found = {h[0] for h in find_leaks(block, [words(t) for t in as_texts(batch.column(2))])}
            if found:
                yield batch.select([0, 1]).take(pa.array(sorted(found), pa.int64()))
        trim()

    return run
