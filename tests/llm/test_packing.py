from collections import defaultdict
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.llm.packing import best_boundaries, pack


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


@given(st.dictionaries(st.integers(0, 60), st.integers(1, 50), min_size=1, max_size=9), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_boundaries_are_optimal(histogram, buckets):
    bounds = best_boundaries(list(histogram.items()), buckets)
    lengths = sorted(histogram)
    least = min(padding(histogram, [*c, lengths[-1]]) for k in range(min(buckets, len(lengths))) for c in combinations(lengths[:-1], k))
    assert len(bounds) <= buckets and bounds == sorted(set(bounds)) and padding(histogram, bounds) == least


def check(rows, budget):
    batches = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.bucket_len and r.padding == r.bucket_len - r.n_tokens
        batches[r.batch_id].append(r)
    assert sorted(batches) == list(range(len(batches)))
    for members in batches.values():
        assert {r.slot for r in members} == set(range(len(members))) and len({r.bucket for r in members}) == 1
        assert {r.batch_docs for r in members} == {len(members)} and {r.batch_tokens for r in members} == {sum(r.n_tokens for r in members)}
        assert len(members) == 1 or len(members) * members[0].bucket_len <= budget
    return batches


def test_batches(spark):
    rows = [(i, (i * i) % 701) for i in range(1_500)] + [(9_999, 100_000), (None, 7), (None, None), (5, 25), (5, 25)]
    rows = pack(spark.createDataFrame(rows, "doc_id long, n_tokens long").repartition(7), token_budget=4_096, buckets=8).collect()
    batches = check(rows, 4_096)
    assert len(rows) == 1_505 and len({r.bucket for r in rows}) == 8
    for b in {r.bucket for r in rows}:  # only the last batch of a bucket is not full
        mine = [m for m in batches.values() if m[0].bucket == b]
        full = max(1, 4_096 // max(1, mine[0][0].bucket_len))
        assert sorted(len(m) for m in mine)[1:] == [full] * (len(mine) - 1)
    ordered = sorted(rows, key=lambda r: (r.batch_id, r.slot))
    assert [(r.n_tokens, r.doc_id if r.doc_id is not None else -1) for r in ordered] == sorted((r.n_tokens, r.doc_id if r.doc_id is not None else -1) for r in rows)


def test_one_length_empty_texts_and_empty_table(spark):
    same = pack(spark.createDataFrame([(i, 0) for i in range(10)], "doc_id long, n_tokens long"), token_budget=4).collect()
    assert len(check(same, 4)) == 3 and {r.bucket_len for r in same} == {0}
    assert pack(spark.createDataFrame([], "doc_id long, n_tokens long, bucket string, batch_id string")).collect() == []
