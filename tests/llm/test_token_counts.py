import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from earshot.llm.token_counts import MergeTable, TokenCounter, token_counts
from tests.llm.cases import empty_docs, odd_docs, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = TokenCounter(PATH)


def library_count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@given(st.text(alphabet=st.sampled_from(list("abesthAB'019.,! \n\t éß日🏳<|>endoftext")), max_size=60))
@settings(max_examples=400, deadline=None)
def test_counts_are_the_library_s(text):
    assert COUNTER.counts([text]) == [library_count(text)]


def test_runs_of_one_symbol_and_long_pieces():
    table_ = MergeTable(PATH)
    pieces = ["a" * n for n in range(1, 40)] + ["ab" * 2_000, "=" * 777]
    assert table_.counts([p.encode() for p in pieces]).tolist() == [library_count(p) for p in pieces]
    assert table_.counts([]).tolist() == []


def test_documents_and_odd_rows(spark):
    for docs in (table(spark, "documents"), odd_docs(spark), empty_docs(spark)):
        got = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, PATH).collect())
        want = [(len((r.text or "").encode()), library_count(r.text)) for r in docs.collect()]
        assert got == sorted((b, n, n > 512) for b, n in want)
