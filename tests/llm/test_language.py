import numpy as np
from pyspark.sql import functions as F

from earshot.llm.common import fold
from earshot.llm.language import UNDETERMINED, Presence, _labelled_sample, fit_language, grams, of_known_language, predict_language, with_language
from tests.llm.cases import empty_docs, odd_docs, table


def test_held_out_languages(spark):
    docs = table(spark, "documents", "0.01")
    model = fit_language(docs.filter(fold("doc_id", 3) != 1))
    truth = {r.doc_id: r.lang for r in docs.filter(fold("doc_id", 3) == 1).collect()}
    got = {r.doc_id: r for r in predict_language(docs, model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, lang in truth.items()]) > 0.97 and all(0 <= r.score <= 1 for r in got.values())


def test_undetermined_odd_rows_and_no_model(spark):
    docs = odd_docs(spark)
    model = fit_language(docs, per_language=20, landmarks=5)
    rows = predict_language(docs, model).collect()
    assert len(rows) == docs.count()
    texts = [r.text for r in docs.collect()]
    none = sum(not t or not any(c.isalpha() for c in t) for t in texts)
    assert sum(r.lang_pred == UNDETERMINED for r in rows) == none and all(r.score == 0 for r in rows if r.lang_pred == UNDETERMINED)
    assert {r.lang_pred for r in rows} <= {UNDETERMINED, "en", "fr"}
    kept = with_language(docs, model).filter(f"lang_pred <> '{UNDETERMINED}'").select("doc.*")
    assert kept.schema == docs.schema and kept.count() == len(texts) - none
    assert fit_language(empty_docs(spark)) is None
    assert {(r.lang_pred, r.score) for r in predict_language(docs, None).collect()} == {(UNDETERMINED, 0.0)}
    assert predict_language(empty_docs(spark), model).collect() == []


def test_presence_against_sets():
    texts = ["The cat, the CAT!", "chat noir", "", "ñandú 12 ñ"]

    def brute(t, n):
        clean = " ".join("".join(c if c.isalpha() else " " for c in f" {t.lower()} ").split())
        padded = f" {clean} " if clean else " "
        return {padded[i : i + n] for i in range(len(padded) - n + 1)}

    each = [grams([t], 3)[0] for t in texts]
    vocabulary = [np.unique(np.concatenate([e[o][1] for e in each])) for o in range(3)]
    rows, has_letter = Presence(vocabulary)(texts)
    assert has_letter.tolist() == [True, True, False, True]
    assert rows.sum(1).tolist() == [sum(len(brute(t, n)) for n in (1, 2, 3)) for t in texts]


def test_a_small_language_of_own_script_is_known(spark):
    rng = np.random.default_rng(3)
    text = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(60))
    large = {"de": "abcdefghijkl", "en": "ghijklmnopqr", "fr": "mnopqrstuvwx", "it": "stuvwxyzabcd"}
    rows = [(k, text(letters)) for k, letters in large.items() for _ in range(40)] + [("zz", text("αβγδεζηθικλμ")) for _ in range(5)]
    docs = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = fit_language(docs, vocabulary=600)
    asked = spark.createDataFrame([(0, text("αβγδεζηθικλμ")), (1, text(large["de"])), (2, "привет мир"), (2, text(large["fr"])), (None, "привет"), (None, text(large["it"])), (3, None), (4, "12 34")], "doc_id long, text string")
    kept = of_known_language(asked, model)
    assert kept.schema == asked.schema and sorted(str(r.doc_id) for r in kept.collect()) == ["0", "1", "2", "None"]  # by brute force: those with a letter of the five alphabets
    assert all(set(r.text) & set("abcdefghijklmnopqrstuvwxαβγδεζηθικλμ") for r in kept.collect())
    assert of_known_language(asked, None).collect() == [] and of_known_language(asked.limit(0), model).collect() == []
    asked = asked.filter("doc_id < 2")
    assert {r.doc_id: r.lang_pred for r in predict_language(asked, model).collect()} == {0: "zz", 1: "de"}


def test_one_key_gives_one_text_to_the_sample(spark):
    """However many rows it has: the sample is no larger than the bound."""
    hot = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("abc "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    rest = spark.createDataFrame([(100 + i, f"efg {i}", "en") for i in range(50)], "doc_id long, text string, lang string")
    for seven in range(3):
        shifted = hot.withColumn("doc_id", F.lit(seven).cast("long")).unionByName(rest)
        sample = _labelled_sample(shifted, "doc_id", "text", "lang", 300)
        assert len(sample) <= 51 and sum(t.startswith("abc") for _, t in sample) <= 1
