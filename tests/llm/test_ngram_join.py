import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.classic.dataframe import DataFrame

from earshot.llm import ngram_join, signature_tree
from earshot.llm.components import components
from earshot.llm.ngram_join import keep_one_per_component, ngram_components, prefix_size, shingles
from earshot.llm.signature_tree import bitmaps, counts, may_count, overlapping_pairs, signature
from tests.llm.cases import empty_docs, frame, odd_docs, table


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def gram_set(text, words):
    split = (text or "").encode().lower().split()
    return frozenset(tuple(split[i : i + words]) for i in range(max(1, len(split) - words + 1))) if split else frozenset()


def brute(rows, words, percent):
    """(doc_id, set size, component): rows of one doc_id are one node."""
    sets = [(r.doc_id, gram_set(r.text, words)) for r in rows]
    holders: dict = {}
    for k, (i, s) in enumerate(sets):
        for g in s if i is not None else ():
            holders.setdefault(g, []).append(k)
    pairs = {(a, b) for members in holders.values() for a in members for b in members if a < b}
    similar = [(sets[a][0], sets[b][0]) for a, b in pairs if 100 * len(sets[a][1] & sets[b][1]) >= percent * len(sets[a][1] | sets[b][1])]
    found = union_find({i for i, _ in sets if i is not None}, similar)
    return sorted(((i, len(s), found.get(i)) for i, s in sets), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(seed, n=160):
    """A passage with more and more words changed, whole families of it, short texts, and unrelated ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    out = []
    for _ in range(4):
        base = [word() for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(n // 5):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    passage = " ".join(word() for _ in range(30))
    out += [" ".join(word() for _ in range(rng.randrange(1, 60))) + " " + passage for _ in range(n // 5)]
    return out


@given(st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=40), min_size=2, max_size=40), st.sampled_from([50, 80, 90]), st.booleans())
@settings(max_examples=150, deadline=None)
def test_the_tree_leaves_every_similar_pair(sets, percent, two_sides):
    arrays = [np.array(sorted((x * 0x9E3779B97F4A7C15) % 2**64 for x in s), np.uint64) for s in sets]
    sides = np.array([(1 + i % 2) if two_sides else 4 for i in range(len(sets))])
    comps = np.arange(len(sets)) // 2
    i, j = overlapping_pairs(bitmaps([signature(a) for a in arrays]), np.array([len(s) for s in sets]), comps, sides, percent)
    left = set(zip(i.tolist(), j.tolist()))
    for b in range(len(sets)):
        for a in range(b):
            similar = 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
            wanted = similar and comps[a] != comps[b] and (not two_sides or sides[a] != sides[b])
            assert (a, b) in left or not wanted


@given(st.lists(st.sets(st.integers(0, 200), min_size=4, max_size=160), min_size=2, max_size=20), st.sampled_from([50, 80, 90, 100]))
@settings(max_examples=150, deadline=None)
def test_counts_leave_every_similar_pair(sets, percent):
    arrays = [np.array(sorted((x * 0x9E3779B97F4A7C15) % 2**64 for x in s), np.uint64) for s in sets]
    before, signature_tree.COUNTED = signature_tree.COUNTED, 8
    packed = [counts(a, percent) for a in arrays]
    signature_tree.COUNTED = before
    i, j = np.triu_indices(len(sets), 1)
    left = may_count(packed, np.array([len(s) for s in sets]), i, j, percent)
    for keep, a, b in zip(left.tolist(), i.tolist(), j.tolist()):
        assert keep or 100 * len(sets[a] & sets[b]) < percent * len(sets[a] | sets[b])


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("n", [1_000, 3_000, 10_000])
def test_unrelated_large_sets_leave_no_pair(n, percent):
    """Bitmaps of one width are full by then; also where sizes differ a little."""
    rng = np.random.default_rng(n)
    arrays = [np.unique(rng.integers(0, 2**63, n + k % 40, dtype=np.uint64)) for k in range(300)]
    sizes = np.array([len(a) for a in arrays])
    i, j = overlapping_pairs(bitmaps([signature(a) for a in arrays]), sizes, np.arange(300), np.full(300, 4), percent)
    left = may_count([counts(a, percent) for a in arrays], sizes, i, j, percent)
    assert left.sum() == 0


@given(st.integers(1, 300), st.sampled_from([50, 80, 90, 100]))
def test_prefix_size(n, percent):
    least = -(-percent * n // 100)  # of n-grams shared by a set of n with any set it links with
    assert prefix_size(n, percent) == n - least + 1


def test_shingles():
    assert len(shingles(b"a b c d a b c", 3)) == 4 and len(shingles(b"A  b", 3)) == 1 and len(shingles(b" \n", 3)) == 0
    assert (shingles(b"A B\x0bC", 3) == shingles(b"a b c", 3)).all()
    assert len({shingles(t, 3).tobytes() for t in (b"a b", b"a b c", b"ab", b"a", "é É x".encode(), "é é x".encode())}) == 6


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 50), (51, 51)]])
def test_components(spark, links):
    random.Random(1).shuffle(links)
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find({x for link in links for x in link if link[0] != link[1]} | {50, 51} if links and links[0] else set(), [x for x in links if x[0] != x[1]])
    assert found == {n: c for n, c in want.items() if n in found} and set(found) == {x for a, b in links if a != b for x in (a, b)}


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_documents(spark, words, percent):
    docs = table(spark, "documents")
    assert got(ngram_components(docs, words=words, percent=percent)) == brute(docs.collect(), words, percent)


def test_near_copies_in_small_blocks(spark, monkeypatch):
    """With frequent n-grams last, without seeds, and hot n-grams cut into many blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "HOT", 3)
    docs = frame(spark, near_copies(1))
    want = brute(docs.collect(), 3, 80)
    assert got(ngram_components(docs, words=3, percent=80)) == want
    monkeypatch.setattr(ngram_join, "_seed_pairs", lambda reps, percent: reps.select(reps.rep.alias("a"), reps.rep.alias("b")).limit(0))
    assert got(ngram_components(docs, words=3, percent=80)) == want


@pytest.mark.parametrize("block", [1_024, 4])
def test_a_pair_is_told_once(spark, monkeypatch, block):
    """Whatever the n-grams it shares and the tasks these fall into: as many rows as pairs leave the trees, and all similar pairs."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    told = []
    monkeypatch.setattr(DataFrame, "distinct", lambda df: told.append(df) or df.dropDuplicates())
    draw = random.Random(7)
    base = [draw.randrange(1 << 40) for _ in range(60)]
    sets = [np.unique(np.array([g if draw.random() > 0.1 else draw.randrange(1 << 62, (1 << 63)) for g in base], np.uint64)) for _ in range(40)]
    rows = [(i, len(s), i, [int(g) for g in s[: prefix_size(len(s), 70)].view(np.int64)], bytearray(signature(s) + counts(s, 70))) for i, s in enumerate(sets)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pairs = ngram_join._met_in_trees(spark.createDataFrame(rows, "rep long, n long, comp long, prefix array<long>, sig binary").repartition(3), 70).collect()
    rows_told = told[-1].count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    similar = {(i, j) for i in range(40) for j in range(i + 1, 40) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 70 * len(np.union1d(sets[i], sets[j]))}
    assert len(similar) > 100 and similar <= {tuple(p) for p in pairs} and rows_told == len(pairs)


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark)
    assert got(ngram_components(docs, words=3, percent=90)) == brute(docs.collect(), 3, 90)
    kept = keep_one_per_component(docs)
    assert kept.schema.names == docs.schema.names
    assert ngram_components(empty_docs(spark)).collect() == []


def test_a_key_with_two_texts_joins_their_classes(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (2, "x y z u"), (3, "x y z u"), (4, "q")], "doc_id long, text string")
    assert got(ngram_components(docs, words=3, percent=90)) == brute(docs.collect(), 3, 90)
