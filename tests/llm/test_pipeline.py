import corpus_pipeline
from earshot.llm.decontaminate import words
from tests.llm.cases import empty_docs, odd_docs, table
from tests.llm.test_exact_dedup import brute as equal_groups
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_packing import check



def test_every_stage_against_brute_force(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, "documents")
    benchmark = [words(r.text) for r in table(spark, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        left = [r.doc_id for r in after.collect()]
        assert len(left) == len(set(left))
        if name == "language":
            assert set(left) == {r.doc_id for r in before if any(c.isalpha() for c in r.text or "")}
        elif name == "exact_dedup":
            assert set(left) == {keep for _, keep, *_ in equal_groups(before)[0]}
        elif name == "near_dedup":
            assert set(left) == {c for _, _, c in components(before, 5, 80)}
        elif name == "decontaminate":
            texts = {r.doc_id: words(r.text) for r in before}
            whole = {d for d, t in texts.items() if any(t[a : a + len(w)] == w for w in benchmark for a in range(len(t) - len(w) + 1))}
            assert whole and set(texts) - set(left) >= whole and len(left) >= len(texts) - len(whole) - 2
        else:
            assert set(left) == {r.doc_id for r in before}
            check(after.collect(), 65_536)
        if name != "packing":
            assert after.schema.names == docs.schema.names
        docs = after


def test_odd_rows_and_an_empty_table(spark, tmp_path):
    for which, docs in (("odd", odd_docs(spark)), ("empty", empty_docs(spark))):
        docs.write.parquet(f"{tmp_path}/{which}/documents.parquet")
        table(spark, "benchmark").write.parquet(f"{tmp_path}/{which}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{which}").collect()
        kept = {r.text for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
        assert len(rows) == len({"".join(t.split(" ")).replace("\n", "") for t in kept})
