import random
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.llm.decontaminate import build_block, closest_passages, find_leaks, leaks, without_leaks, words
from tests.llm.cases import empty_docs, odd_docs, table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@given(st.lists(st.integers(0, 3), min_size=1, max_size=8), st.lists(st.integers(0, 3), min_size=0, max_size=10), st.sets(st.integers(0, 10), min_size=1))
@settings(max_examples=300, deadline=None)
def test_closest_passage_from_any_marked_place(item, text, places):
    places = {p for p in places if p <= len(text)} or {0}
    padded = np.array([text + [-2] * (10 - len(text))])
    edits, first, used = closest_passages(np.array([item]), padded, np.isin(np.arange(11), list(places))[None, :])
    passages = [(distance(item, text[a:b]), a, b - a) for a in places for b in range(a, len(text) + 1)]
    assert (edits[0], first[0], used[0]) == min(passages)


def prose(rng, n):
    return [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice(['', 'a', 'en', 'or'])}" for _ in range(n)]


def edited(rng, item, k):
    out = list(item)
    for _ in range(k):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[at : at + 1] = [] if kind == 0 else ["zzz"] if kind == 1 else ["zzz", out[at]]
    return out


def test_planted_passages_are_found_and_others_are_not():
    rng = random.Random(3)
    items = [(i, " ".join(prose(rng, rng.randrange(12, 60)))) for i in range(60)]
    block = build_block(items, 0.2, 0.99)
    planted, docs = 0, []
    for i, text in items * 4:
        item = words(text)
        k = rng.randrange(0, int(len(item) * 0.2) + 1)
        docs.append((i, prose(rng, rng.randrange(0, 300)) + edited(rng, item, k) + prose(rng, rng.randrange(0, 300))))
        planted += 1
    found = {(d, block.ids[x]) for d, x, *_ in find_leaks(block, [d for _, d in docs])}
    assert len({(n, i) for n, (i, _) in enumerate(docs)} & found) >= 0.99 * planted
    for d, x, e, first, n in find_leaks(block, [d for _, d in docs]):
        item = words(items[x][1])
        assert e <= len(item) * 0.2 and distance(item, docs[d][1][first : first + n]) == e
    assert find_leaks(block, [prose(rng, 2_000) for _ in range(60)]) == []


def test_short_items_stand_word_for_word():
    block = build_block([(1, "one two three"), (2, ""), (3, None), (4, "solo")], 0.2, 0.99)
    found = find_leaks(block, [words("x One, TWO three y"), words("one two tree"), [], words("a solo b"), words("one two")])
    assert [(d, block.ids[i], e, s, n) for d, i, e, s, n in found] == [(0, 1, 0, 1, 3), (3, 4, 0, 1, 1)]


def test_a_leak_at_the_edge_of_the_text():
    rng = random.Random(4)
    item = prose(rng, 30)
    block = build_block([(7, " ".join(item))], 0.2, 0.99)
    for doc in (item[4:], item[:-4], item[3:] + ["x"], ["x"] * 50 + item[:-5]):
        assert [i for _, i, *_ in find_leaks(block, [doc])] == [0]


def test_documents_in_blocks_of_items(spark):
    docs, benchmark = table(spark, "documents"), table(spark, "benchmark")
    rows = sorted(map(tuple, leaks(docs, benchmark).collect()))
    assert rows == sorted(map(tuple, leaks(docs, benchmark, block_items=7).collect()))
    texts, items = {r.doc_id: words(r.text or "") for r in docs.collect()}, {r.item_id: words(r.text) for r in benchmark.collect()}
    whole = {(d, i) for d, t in texts.items() for i, w in items.items() if any(t[a : a + len(w)] == w for a in range(len(t) - len(w) + 1))}
    assert whole == {(r[0], r[1]) for r in rows if r[2] == 0} and whole
    clean = without_leaks(docs, benchmark)
    assert {r.doc_id for r in clean.collect()} == set(texts) - {r[0] for r in rows} and clean.columns == docs.columns


def test_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark)
    benchmark = spark.createDataFrame([(1, "the same text again and again"), (1, "the same text again and again"), (2, None), (None, "no key here")], "item_id long, text string")
    found = leaks(docs, benchmark).collect()
    same = [r.doc_id for r in docs.collect() if r.text and words(r.text) == words("the same text again and again")]
    assert sorted(r.doc_id for r in found if r.item_id == 1) == sorted(same * 2)
    assert [r.doc_id for r in found if r.item_id is None] == [None]
    kept = without_leaks(docs, benchmark)
    assert kept.schema == docs.schema and kept.count() == docs.count() - len(same) - 1
    assert leaks(empty_docs(spark), benchmark).collect() == [] and without_leaks(empty_docs(spark), benchmark).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks(docs, none).collect() == [] and without_leaks(docs, none).count() == docs.count()


def test_long_items_in_repetitive_texts():
    """Every passage of a text that repeats itself is a window; the closest one is that of all beginnings."""
    rng = random.Random(8)
    phrase = prose(rng, 40)
    item, doc = (phrase * 8)[:300], edited(rng, phrase * 40, 60)
    block = build_block([(1, " ".join(item)), (2, " ".join(prose(rng, 300)))], 0.2, 0.99)
    ((_, i, e, first, n),) = find_leaks(block, [doc])
    row = [0] * (len(doc) + 1)  # the fewest edits of any passage
    for x, word in enumerate(item, 1):
        last, row = row, [x]
        for y, other in enumerate(doc, 1):
            row.append(min(last[y] + 1, row[-1] + 1, last[y - 1] + (word != other)))
    assert (i, e) == (0, min(row)) and distance(item, doc[first : first + n]) == e


def test_a_long_item_costs_its_length_times_the_text():
    rng = random.Random(9)
    phrase = prose(rng, 50)
    block = build_block([(1, " ".join((phrase * 30)[:1500]))], 0.2, 0.99)
    began = time.process_time()
    assert find_leaks(block, [edited(rng, phrase * 200, 300)])
    assert time.process_time() - began < 30  # it takes about 4 s; every window by itself took over 200 s


def test_items_the_tables_cannot_serve_are_searched_exactly():
    rng = random.Random(10)
    items = [(i, " ".join(prose(rng, rng.randrange(20, 60)))) for i in range(40)]
    few = build_block(items, 0.2, 0.99, most_tables=4)
    assert few.exact.any() and not build_block(items, 0.2, 0.0).exact.any()
    for i in np.flatnonzero(few.exact).tolist():
        item = words(items[i][1])
        doc = prose(rng, 100) + edited(rng, item, int(len(item) * 0.2)) + prose(rng, 100)
        assert i in [x for _, x, *_ in find_leaks(few, [doc])]
