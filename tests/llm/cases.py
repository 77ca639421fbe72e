"""Rows that every operator must take: nulls, empty and very long texts, repeated rows, clashing column names."""

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
ODD_TEXTS = [
    None, "", "   ", "\n\t", "a", "Two words", "!!! ??? ...", "é ñ ü ß", "日本語 テキスト", "the same text again and again", "the same  text again\nand again",
    "the same text again and again", LONG, "x" * 3_000, "\x00 \x85 　 zero", "<|endoftext|> it's o'clock 1,234.5",
]
CLASHING = (
    "tokens", "shard", "meta", "row", "digest", "norm", "n", "key", "rep", "comp", "doc", "at", "part", "met", "bucket", "batch_id", "score", "lang_pred",
    "id", "label", "best", "kept", "text_sha256", "component_id", "instances", "value", "a", "b", "__text",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def odd_docs(spark, texts=ODD_TEXTS, null_ids=True):
    """The odd texts under keys 0, 1, ..; some rows twice, some without key, other columns null or not."""
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "src0"][i % 2], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += rows[3:6] + ([(None, "no key here", "en", None, None), (None, None, None, None, None)] if null_ids else [])
    return spark.createDataFrame([(*r, *["clash" if r[0] else None] * len(CLASHING)) for r in rows], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def frame(spark, texts, **columns):
    """doc_id 0, 1, .. with the texts."""
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def table(spark, name, sf="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")
