import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.llm.pii import _candidates, base_spans, joined, luhn, personal_data, score_graph
from tests.llm.cases import empty_docs, odd_docs, table

#: The patterns as the contract gives them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


@given(st.text(alphabet=st.sampled_from(list("aZ.%+-@@..0159 ()é\n")), max_size=40))
@settings(max_examples=1_500, deadline=None)
def test_spans_of_the_patterns(text):
    assert base_spans(text) == brute(text)


@given(st.lists(st.sampled_from(["a@b.c", "@", "1.2.3.4", ".", "256", "4111 1111 1111 1111", "+1 (555) 555-0100", "-", " ", "x.y@z", "é", "4111111111111111", "0000001.2.3.4"]), max_size=8))
@settings(max_examples=800, deadline=None)
def test_spans_of_joined_pieces(pieces):
    assert base_spans("".join(pieces)) == brute("".join(pieces))


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112") and luhn("0" * 16)


def test_long_runs_take_no_square_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 100_000, "1 " * 150_000):
        base_spans(text)


def test_documents_and_odd_rows(spark):
    for docs in (table(spark, "documents"), odd_docs(spark), empty_docs(spark)):
        got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in personal_data(docs).collect()), key=str)
        want = []
        for r in docs.collect():
            spans = brute(r.text or "")
            want.append((r.doc_id, *[sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")], hashlib.sha256(joined(spans).encode()).hexdigest()))
        assert got == sorted(want, key=str)


def test_contexts_reveal_unseen_identifiers(spark):
    """Account numbers stand where cards stand; ticket numbers stand where no seed does."""
    texts = [f"order {i}: please pay with card {4111111111111111} today" for i in range(3)]
    good = [f"{4000000000000000 + k}" for k in range(400) if luhn(f"{4000000000000000 + k}")]
    texts += [f"someone wrote: pay with card {c} now" for c in good]
    texts += ["and pay with card 40000ABC99 now", "build ticket 12345678 done", "build ticket 87654321 done"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in personal_data(docs).collect()}
    at = texts[-3].index("40000ABC99")
    assert rows[len(texts) - 3].spans == f"other:{at}:{at + 10}" and rows[len(texts) - 3].n_other == 1
    assert rows[len(texts) - 1].spans == "" and rows[0].spans.startswith("card:") and rows[0].n_other == 0


def test_scores_spread_over_rounds(spark):
    """A context of seeds reveals a value, and that value's other context then reveals the next."""
    edges = [("c1", v, True) for v in range(30)] + [("c1", 100, False)] + [("c2", 100, False), ("c2", 101, False)]
    frame = spark.createDataFrame(edges, "context string, value long, seed boolean")
    once = {r.value: r.confidence for r in score_graph(frame, rounds=1, damping=2.0, least=1)[1].collect()}
    more = {r.value: r.confidence for r in score_graph(frame, rounds=3, damping=2.0, least=1)[1].collect()}
    assert once[0] == 1 and 0.8 < once[100] < 1 and once[101] == 0 and 0 < more[101] < more[100]


def test_candidates_are_tokens_and_runs():
    def found(text):
        return [text[s:e] for s, e, *_ in _candidates(text, base_spans(text))]

    for one in ("555 123 4567", "GB29 NWBK 6016 1331 9268 19", "4111 1111 1111 1112", "(212) 555-0199", "12/345/678", "123.456.789-00", "40000ABC99"):
        assert found(f"pay with {one} now")[0] == one
    assert found("(555 123 4567) and 1 of 2, 3 IN FULL 4. 5") == ["555 123 4567"]
    assert found("12345678 10.0.0.1 87654321 22") == ["12345678", "87654321 22", "87654321"]  # a seed parts runs
    for text in ("1 " * 150_000, "1 A " * 100_000, "(1)" * 100_000, "1.2 " * 100_000):
        _candidates(text, [])


def planted():
    """(text, spans to find): spaced identifiers in contexts of five to eleven seeds, and the same shapes in contexts of none."""
    shapes = ["{0} {1} {2}", "GB29 NWBK {0} {1} {2} 19", "({3}) {4}-{0}", "{0} {1} {2} 0000", "{3}/{4}/{0}", "{0}AB{1}"]
    digits = lambda n, i: str(10 ** (n - 1) + (i * 7919 + 104729) % (9 * 10 ** (n - 1)))
    out = []
    for c in range(12):
        seeds = [f"4{digits(15, c * 1000 + k)}" for k in range(200)]
        for seed in [s for s in seeds if luhn(s)][: 5 + c % 7]:
            out.append((f"a word about this: ref{chr(97 + c)} is {seed} as was said", []))
        for k, shape in enumerate(shapes[:2] if c % 2 else shapes[2:4]):
            one = shape.format(*[digits(4, 97 * c + 31 * k + j) for j in range(3)], digits(3, c + k), digits(3, c + 5 * k))
            if base_spans(one):
                continue
            text = f"another word: ref{chr(97 + c)} is {one} as was said"
            out.append((text, [(text.index(one), text.index(one) + len(one))]))
            decoy = shape.format(*[digits(4, 5000 + 97 * c + 31 * k + j) for j in range(3)], digits(3, 500 + c + k), digits(3, 500 + c + 5 * k))
            out.append((f"a table of lot{chr(97 + c)} has {decoy} in it", []))
    return out


def test_planted_identifiers_are_found(spark):
    texts = planted()
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, *map(int, s.split(":")[1:])) for r in personal_data(docs).collect() for s in r.spans.split(",") if s.startswith("other")}
    want = {(i, *s) for i, (_, spans) in enumerate(texts) for s in spans}
    assert len(want) >= 20 and got == want


def test_contexts_of_few_seeds(spark):
    """`least` instances are enough if nearly all are seeds, fewer are not; a context mostly of other numbers is not, however many seeds it has."""
    good = [str(n) for n in range(4000000000000000, 4000000000000400) if luhn(str(n))]
    def others(seeds, loose):
        texts = [f"pay {s}" for s in good[:seeds]] + [f"pay {70000 + i} {1234 + i}" for i in range(loose)]
        return sum(r.n_other for r in personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())

    assert others(5, 1) == 1 and others(3, 1) == 0 and others(12, 40) == 0
