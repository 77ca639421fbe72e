import tracemalloc

import numpy as np
import pytest

from earshot.llm.common import fold
from earshot.llm.quality import CHUNK, OVERLAP, WIDTH, ByteNet, chunks, fit_quality, score_quality
from tests.llm.cases import empty_docs, odd_docs, table


@pytest.mark.parametrize("n", [0, 1, OVERLAP, CHUNK - 1, CHUNK, CHUNK + 1, 5_000])
def test_chunks_cover_the_text(n):
    text = bytes(np.random.default_rng(n).integers(1, 256, n, dtype=np.uint8))
    rows = chunks(text)
    step = CHUNK - OVERLAP
    joined = b"".join(r.tobytes()[:step] for r in rows[:-1]) + rows[-1].tobytes()
    assert joined[:n] == text and not any(joined[n:]) and len(rows) >= 1


def test_held_out_quality(spark):
    docs, labels = table(spark, "documents", "0.01"), table(spark, "labels", "0.01")
    net = fit_quality(docs, labels.filter(fold("doc_id", 5) != 0))
    truth = {r.doc_id: r.quality for r in labels.filter(fold("doc_id", 5) == 0).collect()}
    got = {r.doc_id: r for r in score_quality(docs, net).collect()}
    assert np.mean([got[i].predicted == q for i, q in truth.items()]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    odd = score_quality(odd_docs(spark), net)
    assert odd.count() == odd_docs(spark).count() and odd.filter("score IS NULL").count() == 0
    assert score_quality(empty_docs(spark), net).collect() == []


def test_without_labels(spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert fit_quality(odd_docs(spark), none) is None
    assert {r.score for r in score_quality(odd_docs(spark), None).collect()} == {0.5}
    one_class = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    net = fit_quality(odd_docs(spark), one_class)
    assert all(r.score > 0.3 for r in score_quality(odd_docs(spark), net).collect())


def test_pooled_in_small_blocks():
    """The pooled values are the greatest of `responses`, bit by bit, and what is held for a text beside its chunks does not leave a core's cache."""
    draw = np.random.default_rng(4)
    net = ByteNet(draw.normal(0, 0.3, (256, 8)).astype(np.float32), draw.normal(0, 0.3, (WIDTH * 8, 32)).astype(np.float32), draw.normal(0, 1, 32).astype(np.float32), np.zeros(65), np.zeros((2, 64)))
    text = draw.integers(1, 256, 300_000, dtype=np.uint8).tobytes()
    rows = chunks(text)
    want = np.maximum(np.max([net.responses(rows, shift).max(1) for shift in range(4)], axis=0) + net.bias, 0)
    tracemalloc.start()
    got = net.features([text])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got[32:] == want.max(0)).all() and peak < 8 << 20


def test_every_place_is_pooled():
    """A pattern answers alike at every offset, up to the last window of a chunk."""
    rng = np.random.default_rng(1)
    net = ByteNet(rng.normal(size=(256, 8)), rng.normal(size=(WIDTH * 8, 16)), np.zeros(16), np.zeros(33), np.stack([np.zeros(32), np.ones(32)]))
    net.vectors[0] = 0
    at = [bytes(k) + b"pattern of some bytes" + bytes(100 - k) for k in range(8, 16)]
    pooled = np.concatenate([net.pooled(chunks(t)) for t in at])
    assert np.allclose(pooled, pooled[0])
    row = chunks(rng.integers(1, 256, CHUNK, dtype=np.uint8).tobytes())
    brute = np.stack([net.vectors[row[0, s : s + WIDTH]].reshape(-1) @ net.filters for s in range(CHUNK - WIDTH + 1)]).max(0)
    assert np.allclose(net.pooled(row)[0], np.maximum(brute, 0))
