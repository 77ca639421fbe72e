"""Similarity join of documents on their word n-grams, with signature trees.

Two documents link when 100 * |x & y| >= percent * |x | y| for their sets of distinct word n-grams. The join is
exact and never lists the pairs of a group of copies:

1. Documents with equal sets become one class, named by its smallest key.
2. Classes that share min-hashes are compared with one centre per bucket (the class with most copies). What links
   is a component already, so a large group of near copies costs one comparison per member.
3. Linked sets share one of their first few n-grams under any one order of all n-grams (prefix filter). The order
   is by hash, with n-grams met in many prefixes by hash last, so passages that many documents share do not bring
   them together. Only n-grams whose classes are not all in one component go on.
4. The classes that meet at an n-gram form a signature tree (`signature_tree`); an n-gram with many classes is cut
   into blocks by size band and hash, and pairs of blocks that sizes allow are joined. Large sets carry counts beside
   their bitmap, by which the pairs of a tree's leaves are bounded once more. A pair is told at one of the n-grams it meets at.
5. Pairs the trees leave are bounded once more with wide bitmaps and then verified on the whole sets.
6. Components of all links.

What comes out are the components, exactly. Links are not listed: n-grams, tree nodes and pairs inside one component
are pruned, so of a family of near copies about one link per member is ever verified, and neither the pairs nor their
number can be had from it.
"""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_bytes, counted, discard, map_texts, resident, trim
from earshot.llm.components import components
from earshot.llm.signature_tree import BITS, bitmaps, counts, may_count, may_overlap, overlapping_pairs, signature
from earshot.sources.snapshots import settle

MIN_HASHES = 6
HOT = 32
HOT_SLOTS = 1 << 22
BLOCK = 1_024
WIDE = 4_096  # bits of the second bound
FIRST = 8  # n-grams by which a pair knows where else it meets
HELD_PAIRS = 1 << 20  # pairs a task remembers having told
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words: int) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes.

    A-Z are lower-cased, words are what ASCII white space separates; a text with fewer words is one n-gram.
    """
    split = text.lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, split), np.uint64, len(split))
    size = min(words, len(h))
    total = np.full(len(h) - size + 1, np.uint64(size))
    for i in range(size):
        total = _mix(total + h[i : len(h) - size + 1 + i] * _K[0] + _K[1])
    return np.unique(total)


def prefix_size(n: int, percent: int) -> int:
    """How many first n-grams a set of n must be known by: two linked sets share one of theirs."""
    return n - -(-percent * n // 100) + 1


def _prefix(members: np.ndarray, percent: int, hot: np.ndarray | None) -> np.ndarray:
    size = prefix_size(len(members), percent) if len(members) else 0
    if hot is None or not size:
        return members[:size]
    slot = members >> np.uint64(42)
    late = (hot[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return np.concatenate([members[~late][:size], members[late]])[:size]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64), pa.int64()))


def _class_rows(docs: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """doc_id, n, key (128 bits of the set), mins, prefix of every row."""

    def make():
        resident(None, None)
        seeds = [_mix(np.full(1, np.uint64(i + 1)))[0] for i in range(MIN_HASHES)]

        def step(texts: pa.Array):
            sets = [shingles(t, words) for t in as_bytes(texts)]
            mins = [np.array([_mix(s ^ seed).min() for seed in seeds], np.uint64) if len(s) else s for s in sets]
            keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            return pa.array(map(len, sets), pa.int64()), keys, _lists(mins), _lists([_prefix(s, percent, None) for s in sets])

        return step

    return map_texts(docs, {"doc_id": F.col(doc_id).cast("long")}, text, make, "n long, key binary, mins array<bigint>, prefix array<bigint>")


def _texts_of(docs: DataFrame, ids: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id and text of the documents in `ids` (a written table), which is broadcast unless there are very many."""
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(counted(ids), "id", "left_semi")


def _signed_rows(docs: DataFrame, doc_id: str, text: str, words: int, percent: int, hot: np.ndarray) -> DataFrame:
    """rep, n, key, prefix with frequent n-grams last, sig of every row."""

    def make():
        resident(None, None)
        def step(texts: pa.Array):
            sets = [shingles(t, words) for t in as_bytes(texts)]
            keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            signs = pa.array([signature(s) + counts(s, percent) for s in sets], pa.binary())
            return pa.array(map(len, sets), pa.int64()), keys, _lists([_prefix(s, percent, hot) for s in sets]), signs

        return step

    return map_texts(docs, {"rep": F.col(doc_id).cast("long")}, text, make, "n long, key binary, prefix array<bigint>, sig binary")


def _with_both(pairs: DataFrame, about: DataFrame, *columns: str) -> DataFrame:
    """The pairs with these columns of both documents, as x_.. and y_.."""
    for end, prefix in (("a", "x"), ("b", "y")):
        pairs = pairs.join(about.select(F.col("id").alias(end), *[F.col(c).alias(f"{prefix}_{c}") for c in columns]), end)
    return pairs.select("a", "b", *[f"{p}_{c}" for p in "xy" for c in columns])


def _verified(docs: DataFrame, pairs: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. Only the documents in pairs are read again."""
    pairs = settle(pairs, "pairs")
    ids = settle(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")

    def make():
        resident(None, None)
        def step(texts: pa.Array):
            sets = [shingles(t, words) for t in as_bytes(texts)]
            return pa.array(map(len, sets), pa.int64()), pa.array([signature(s, WIDE) for s in sets], pa.binary()), _lists(sets)

        return step

    sets = settle(map_texts(_texts_of(docs, ids, doc_id, text).dropDuplicates(), {"id": "id"}, "text", make, "n long, wide binary, members array<bigint>"), "sets")

    def possible(batches):
        for batch in batches:
            x_size, x, y_size, y = batch.columns[2:]
            keep = may_overlap(bitmaps(x.to_pylist(), WIDE), bitmaps(y.to_pylist(), WIDE), x_size.to_numpy(), y_size.to_numpy(), percent)
            yield batch.select([0, 1]).filter(pa.array(keep))

    schema = pairs.select("a", "b").schema
    left = settle(_with_both(pairs, sets, "n", "wide").mapInArrow(possible, schema).distinct(), "possible")
    shared, sizes = F.size(F.array_intersect("x_members", "y_members")), F.col("x_n") + F.col("y_n")
    similar = (shared > 0) & (100 * shared >= percent * (sizes - shared))
    links = settle(_with_both(left, sets, "n", "members").filter(similar).select("a", "b"), "links")
    discard(pairs, ids, sets, left)
    return links


def _seed_pairs(reps: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class and the centre of a bucket it shares at least two min-hashes with, sizes allowing a link."""
    hashed = reps.select("rep", "n", "copies", F.posexplode("mins").alias("place", "hash"))
    centre = F.max(F.struct("copies", (-F.col("rep")).alias("low"), "n")).alias("c")
    centres = hashed.groupBy("place", "hash").agg(centre, F.count(F.lit(1)).alias("met")).filter("met > 1")
    centres = centres.select("place", "hash", (-F.col("c.low")).alias("centre"), F.col("c.n").alias("centre_n"))
    near = hashed.join(centres, ["place", "hash"]).filter("rep <> centre")
    near = near.filter(100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n"))
    agreeing = near.groupBy("rep", "centre").agg(F.count(F.lit(1)).alias("agree")).filter("agree > 1")
    return agreeing.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()


def _shared_tokens(tokens: DataFrame) -> DataFrame:
    """token, members: the n-grams of (rep, comp, token) that classes of different components hold."""
    met = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("members"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    return met.filter("members > 1 AND low <> high").select("token", "members")


def _hot_slots(shared: DataFrame) -> np.ndarray:
    """A bitmap of fixed size: the hash slots of n-grams that HOT prefixes or more hold. It only orders n-grams, so
    a slot that a rare one shares costs time and no result."""
    slot = F.shiftrightunsigned("token", 42).alias("slot")
    bits = F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS INT)))").alias("bits")
    met = shared.filter(F.col("members") >= HOT).select(slot)
    rows = met.groupBy(F.shiftright("slot", 6).alias("word")).agg(bits).collect()  # at most HOT_SLOTS / 64
    out = np.zeros(HOT_SLOTS // 64, np.int64)
    for r in rows:
        out[r.word] = r.bits
    return out.view(np.uint64)


def _met_in_trees(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of classes of different components that share a prefix n-gram and pass the trees' bounds.

    A pair meets at every n-gram that both prefixes hold, and the bounds say the same at each. So each class carries the first
    of the n-grams it meets others at, and a pair that has some of these in common is told at the least one only.
    """
    tokens = rows.select("rep", "comp", F.explode("prefix").alias("token"))
    shared = tokens.select("token", "rep").join(_shared_tokens(tokens), "token")
    met = shared.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("token", "members"))).alias("met"))  # at most the set's prefix
    first = F.transform(F.sequence(F.lit(1), F.lit(FIRST)), lambda i: F.get("met.token", F.least(i, F.size("met")) - 1)).alias("first")
    held = met.select("rep", first, "met").join(rows.select("rep", "n", "comp", "sig"), "rep")
    members = held.select("rep", "n", "comp", "sig", "first", F.explode("met").alias("at")).select("at.*", "rep", "n", "comp", "sig", "first")

    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    band = F.floor(F.log(F.col("n")) / (log(100 / percent) * 1.000001) if percent < 100 else F.col("n")).cast("int")
    members = members.withColumn("blocks", blocks).withColumn("band", band).withColumn("mine", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))

    def place(kind, band, low, high, side):
        return F.struct(F.lit(kind).alias("kind"), band.alias("band"), low.alias("low"), high.alias("high"), side.alias("side"))

    def around(other):
        mine, band = F.col("mine"), F.col("band")
        side = F.when(mine == other, F.lit(4)).when(mine < other, F.lit(1)).otherwise(F.lit(2))
        return F.array(
            place(1, band, F.least(mine, other), F.greatest(mine, other), side),
            place(2, band, mine, other, F.lit(1)),
            place(2, band - 1, other, mine, F.lit(2)),
        )

    whole = F.array(place(0, F.lit(0), F.lit(0), F.lit(0), F.lit(4)))
    spread = F.flatten(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), around))
    placed = members.select("token", F.explode(F.when(F.col("blocks") == 1, whole).otherwise(spread)).alias("at"), "rep", "n", "comp", "sig", "first")
    group = ["token", "kind", "band", "low", "high"]
    placed = placed.select("token", "at.*", "rep", "n", "comp", "sig", "first").repartition(*group).sortWithinPartitions(*group)
    key = rows.schema["rep"].dataType.simpleString()
    return placed.mapInArrow(_tree_step(percent), f"a {key}, b {key}").distinct()


def _distinct(pairs) -> np.ndarray:
    """The distinct rows of some arrays of pairs."""
    rows = np.concatenate([np.zeros((0, 2), np.int64), *pairs])
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    return rows[np.r_[True, (rows[1:] != rows[:-1]).any(1)]] if len(rows) else rows


def _told_here(token: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pair by pair, whether `token` is the least that the rows of x and y have in common, or they have none."""
    here = np.ones(len(x), bool)
    for a in range(0, len(x), 100_000):
        common = (x[a : a + 100_000, :, None] == y[a : a + 100_000, None, :]).any(2)
        none = ~common.any(1)
        least = np.where(common, x[a : a + 100_000], np.iinfo(np.int64).max).min(1)
        here[a : a + 100_000] = none | (least == token)
    return here


def _tree_step(percent: int):
    def pairs_of(table: pa.Table):
        group = np.stack([table.column(i).to_numpy().astype(np.int64) for i in range(5)], 1)
        first = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(1)])
        sides, reps, sizes, comps = (table.column(i).to_numpy() for i in (5, 6, 7, 8))
        signs = table.column(9).to_pylist()
        firsts = table.column(10).combine_chunks().flatten().to_numpy().reshape(-1, FIRST)
        bits, more = bitmaps([s[: BITS // 8] for s in signs]), [s[BITS // 8 :] for s in signs]
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(group)]):
            if b - a > 1 and (comps[a:b] != comps[a]).any():
                i, j = overlapping_pairs(bits[a:b], sizes[a:b], comps[a:b], sides[a:b].astype(np.int64), percent)
                left = may_count(more[a:b], sizes[a:b], i, j, percent)
                i, j = i[left], j[left]
                left = _told_here(group[a, 0], firsts[a:b][i], firsts[a:b][j])
                i, j = i[left], j[left]
                if len(i):
                    x, y = reps[a:b][i], reps[a:b][j]
                    yield np.stack([np.minimum(x, y), np.maximum(x, y)], 1)

    def run(batches):
        held: list[pa.RecordBatch] = []  # the last group of a batch may go on in the next
        found: list[np.ndarray] = []  # a pair without common first n-grams is told once for all groups of a task
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            keys = [batch.column(i).to_numpy() for i in range(5)]
            same = np.logical_and.reduce([k == k[-1] for k in keys])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                held[-1] = batch.slice(0, cut)
                new = _distinct(pairs_of(pa.Table.from_batches(held)))
                found, size, held = [*found, new], size + len(new), [batch.slice(cut)]
                if size > HELD_PAIRS:
                    found = [_distinct(found)]
                    size = len(found[0])
                    if 2 * size > HELD_PAIRS:
                        yield told(found[0])
                        found, size = [], 0
        if held:
            found.append(_distinct(pairs_of(pa.Table.from_batches(held))))
        if found:
            yield told(_distinct(found))
        trim()

    def told(pairs):
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def ngram_components(docs: DataFrame, *, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Components of documents linked by similar n-gram sets; the links inside a component are not listed or counted.

    One row per row of `docs`: doc_id (an integer), n_shingles (size of its set), component_id (smallest doc_id
    it reaches by links, itself included). Texts that are null, empty or without words have no n-grams and link
    with nothing. Rows that share a doc_id are one document, linked by any of its texts; rows without doc_id link
    with nothing and have no component. An empty table gives no rows.
    """
    first = settle(_class_rows(docs, doc_id, text, words, percent), "ngram_sets")
    named = first.filter("n > 0 AND doc_id IS NOT NULL")
    classes = settle(named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")), "classes")
    about = named.select("key", F.col("doc_id").alias("rep"), "mins", "prefix").dropDuplicates(["key", "rep"])
    reps = settle(classes.join(about, ["key", "rep"]), "reps")
    short = settle(first.select("doc_id", "n", "key"), "documents")
    discard(first)  # the prefixes are in `reps`, once per class
    named = short.filter("n > 0 AND doc_id IS NOT NULL")

    seeds = _verified(docs, _seed_pairs(reps, percent), doc_id, text, words, percent)
    grown = components(seeds).select(F.col("node").alias("rep"), F.col("label").alias("comp"))
    labelled = settle(reps.select("key", "rep", "prefix").join(grown, "rep", "left").withColumn("comp", F.coalesce("comp", "rep")), "labelled")
    discard(reps)
    tokens = labelled.select("rep", "comp", F.explode("prefix").alias("token"))
    shared = settle(_shared_tokens(tokens), "shared")
    signed = _signed_rows(docs, doc_id, text, words, percent, _hot_slots(shared))
    rows = settle(signed.join(labelled.select("key", "rep", "comp"), ["key", "rep"]).dropDuplicates(["key", "rep"]), "signed")
    links = _verified(docs, _met_in_trees(rows, percent), doc_id, text, words, percent)
    discard(labelled, shared, rows)

    several = named.groupBy("doc_id").agg(F.min("key").alias("k"), F.max("key").alias("l")).filter("k <> l").select("doc_id")
    owned = named.join(several, "doc_id").select("doc_id", "key").distinct().join(classes.select("key", "rep"), "key")
    all_links = seeds.union(links).union(owned.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    labels = components(all_links).select(F.col("node").alias("rep"), "label")
    component = classes.join(labels, "rep", "left").select("key", F.coalesce("label", "rep").alias("component_id"))
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    placed = short.filter(linked).select("doc_id", "n", "key").join(component, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return placed.unionByName(short.filter(~linked).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one_per_component(docs: DataFrame, *, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each component the document with the smallest
    doc_id. Rows without doc_id or without words stay; rows that share a doc_id stay or go together."""
    found = ngram_components(docs, words=words, percent=percent, doc_id=doc_id, text=text)
    dropped = settle(found.filter("component_id <> doc_id").select(F.col("doc_id").alias(doc_id)).distinct(), "dropped")
    return docs.join(counted(dropped), doc_id, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
