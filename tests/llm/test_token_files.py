import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from earshot.llm.token_files import read_token_files, shard_offsets, token_digests, write_token_files
from earshot.llm.word_encoder import WordEncoder, token_lengths
from tests.llm.cases import ODD_TEXTS, empty_docs, odd_docs, table

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = WordEncoder(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.text(alphabet=st.sampled_from(list("abAB'sStT019.,!— éÉ̱́\n\t 　日<|>")) , max_size=12), max_size=6))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(texts):
    raw = [t.encode() for t in texts]
    ids, sizes = ENCODER.ids(raw)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes))[:-1]] == [library_ids(t) for t in texts]
    assert ENCODER.sizes(raw).tolist() == sizes.tolist()


def test_special_strings_and_forgetting(monkeypatch):
    texts = ["a<|endoftext|>b.c", "<|startoftext|>", "plain, text!", "y" * 500]
    encoder = WordEncoder(PATH)
    monkeypatch.setattr("earshot.llm.word_encoder.CACHED_PIECES", 2)
    for _ in range(2):
        for t in texts:
            assert encoder.ids([t.encode()])[0].tolist() == library_ids(t)


@pytest.mark.parametrize("by_word", [True, False])
def test_files_hold_the_ids_in_order(spark, tmp_path, by_word):
    docs = table(spark, "documents")
    write_token_files(docs, f"{tmp_path}/f", PATH, end_id=2, by_word=by_word, meta=("lang", "source"))
    files = read_token_files(spark, f"{tmp_path}/f")
    rows = {r.doc_id: r for r in files.collect()}
    digests = {r.doc_id: r for r in token_digests(files).collect()}
    start = 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = [*library_ids(r.text), 2]
        assert rows[r.doc_id].tokens == ids and rows[r.doc_id].meta.lang == r.lang
        assert tuple(digests[r.doc_id]) == (r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_odd_rows(spark, tmp_path):
    docs = odd_docs(spark)
    write_token_files(docs, f"{tmp_path}/f", PATH, end_id=2, by_word=True, meta=("tokens", "meta"))
    files = read_token_files(spark, f"{tmp_path}/f")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.tokens) for r in files.collect())
    assert got == sorted((r.doc_id is None, r.doc_id or 0, [*library_ids(r.text), 2]) for r in docs.collect())
    placed = sorted(token_digests(files).collect(), key=lambda r: r.start)
    assert [r.start for r in placed] == np.cumsum([0, *[r.n_tokens for r in placed]])[:-1].tolist()
    assert [r.doc_id for r in placed[:2]] == [None, None]
    counted = sorted(r.n_tokens for r in token_lengths(docs, PATH, extra=1).collect())
    assert counted == sorted(r.n_tokens for r in placed)


def test_no_end_id_and_empty_table(spark, tmp_path):
    write_token_files(odd_docs(spark, ODD_TEXTS[:3]), f"{tmp_path}/a", PATH, end_id=None, by_word=True)
    assert {tuple(r.tokens) for r in read_token_files(spark, f"{tmp_path}/a").filter("doc_id < 3").collect()} == {()}
    write_token_files(empty_docs(spark), f"{tmp_path}/b", PATH, end_id=2, by_word=True)
    files = read_token_files(spark, f"{tmp_path}/b")
    assert token_digests(files).collect() == [] and shard_offsets(files).collect() == []


def test_selective_reads_and_layout(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    write_token_files(table(spark, "documents"), f"{tmp_path}/f", PATH, end_id=2, by_word=True, row_group_bytes=1 << 16, page_bytes=1 << 12)
    some = read_token_files(spark, f"{tmp_path}/f").filter("doc_id = 7").select("n_tokens")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,7)" in plan and "tokens" not in plan.split("ReadSchema")[1].replace("n_tokens", "")
    files = [pq.ParquetFile(f) for f in glob.glob(f"{tmp_path}/f/*.parquet")]
    columns = [f.metadata.row_group(0).column(i) for f in files if f.metadata.num_row_groups for i in range(f.metadata.num_columns)]
    tokens = [c for c in columns if c.path_in_schema.startswith("tokens")]
    assert tokens and all(c.has_dictionary_page or "DELTA_BINARY_PACKED" in c.encodings for c in tokens)
    assert all(c.has_offset_index for c in columns)
