import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from earshot.llm.exact_dedup import exact_groups, keep_one
from tests.llm.cases import empty_docs, odd_docs, table


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append(r)
    out = []
    for norm, members in groups.items():
        best = max(members, key=lambda r: (len(r.text or ""), r.doc_id is not None, -(r.doc_id or 0)))
        out += [(r.doc_id, best.doc_id, len(members), hashlib.sha256(norm.encode()).hexdigest()) for r in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("digest", [None, lambda norm: F.substring(F.sha2(norm, 256), 1, 1)])
@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_groups(spark, which, digest):
    """Also with a digest of one letter, so that most contents share theirs."""
    docs = {"documents": table(spark, "documents"), "odd": odd_docs(spark), "empty": empty_docs(spark)}[which].repartition(5)
    rows = exact_groups(docs, **({"digest": digest} if digest else {})).collect()
    want, groups = brute(docs.collect())
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == want
    assert sum(r.kept for r in rows) == groups  # one of each, also among rows that repeat a key
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_a_group_over_many_tasks(spark):
    docs = spark.range(0, 4_000, 1, 16).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same  one")).otherwise(F.col("id").cast("string")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(9_000, "same    one"), (8_000, "same    one")], "doc_id long, text string"))
    rows = exact_groups(docs).filter("group_size > 1").collect()
    assert {r.keep_id for r in rows} == {8_000} and len(rows) == 1_336 and [r.doc_id for r in rows if r.kept] == [8_000]


def test_keep_one_keeps_all_columns(spark):
    docs = odd_docs(spark)
    kept = keep_one(docs)
    assert kept.schema == docs.schema and kept.count() == brute(docs.collect())[1]
    assert keep_one(empty_docs(spark)).collect() == []
    whole = table(spark, "documents")  # every row has a key of its own
    left = keep_one(whole)
    assert left.schema == whole.schema and {r.doc_id for r in left.collect()} == {keep for _, keep, *_ in brute(whole.collect())[0]}
    assert left.count() == brute(whole.collect())[1]


@pytest.mark.parametrize("most, hot", [(0, 3), (0, 10**6), (10**6, 3)])
def test_broadcast_and_shuffled_keys_agree(spark, monkeypatch, most, hot):
    monkeypatch.setattr("earshot.llm.common.BROADCAST_ROWS", most)
    monkeypatch.setattr("earshot.llm.exact_dedup.HOT_ROWS", hot)
    docs = table(spark, "documents")
    assert sorted((r.doc_id, r.keep_id) for r in exact_groups(docs).collect()) == sorted((a, b) for a, b, *_ in brute(docs.collect())[0])
    assert keep_one(docs).count() == brute(docs.collect())[1]


@pytest.mark.parametrize("most", [0, 10**6])
def test_content_is_the_key_of_every_step(spark, monkeypatch, most):
    """Two texts under one digest, each in many tasks, beside digests of one text."""
    monkeypatch.setattr("earshot.llm.common.BROADCAST_ROWS", most)
    monkeypatch.setattr("earshot.llm.exact_dedup.HOT_ROWS", 50)
    text = F.element_at(F.array(F.lit("a one"), F.lit("a two"), F.lit("b three")), (F.col("id") % 3 + 1).cast("int"))
    docs = spark.range(0, 300, 1, 12).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = exact_groups(docs, digest=lambda norm: F.substring(norm, 1, 1)).collect()
    assert len(rows) == 300 and {(r.doc_id % 3, r.keep_id, r.group_size) for r in rows} == {(0, 0, 100), (1, 1, 100), (2, 2, 100)}
    assert sorted(r.doc_id for r in rows if r.kept) == [0, 1, 2]
