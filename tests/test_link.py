import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from earshot.functions.text import fold_accents, norm_album, norm_title, slug, url_tail
from earshot.operators import link as L
from tests.helpers import rows

CATALOGUE = "id string, name string, artist string, artist_id string, album_id string, album_name string, album_type string, duration_ms int"
SOURCE = "import_id int, name string, artist_name string, album_name string, duration_ms int"


def values(spark, fn, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r.x for r in df.select(fn(F.col("t")).alias("x")).collect()]


def test_titles(spark):
    assert values(spark, norm_title, "  Café  del Mar (2011 Remaster)", "Song - Live", "Song (Live)", "SONG (Deluxe Edition)", "Oliver", "Song - Remastered", None, "", "A  Special Edition") == [
        "cafe del mar", "song", "song", "song", "oliver", "song", "", "", "a"]


def test_albums(spark):
    assert values(spark, norm_album, "Blue (Deluxe Edition)", "Blue (Remastered 2009) II", "Blue (Live)", None) == ["blue", "blue ii", "blue (live)", ""]


def test_accents_agree_with_full_decomposition(spark):
    texts = ["Beyoncé", "Sigur Rós", "Ñandú", "Žižek", "Ångström", "é", "plain"]
    want = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert values(spark, fold_accents, *texts) == want


def test_every_character_folds_as_its_decomposition(spark):
    """All but Hangul syllables, which stay; vowel signs of Indic scripts are no accents."""
    texts = [chr(c) + "z" for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fold_accents(F.col("t")).alias("x"))
    odd = [r.t for r in got.filter("x <> t").collect() if r.x != "".join(c for c in unicodedata.normalize("NFKD", r.t) if not unicodedata.combining(c))]
    kept = [r.t for r in got.filter("x = t").collect() if r.t != "".join(c for c in unicodedata.normalize("NFKD", r.t) if not unicodedata.combining(c))]
    assert odd == [] and all(0xAC00 <= ord(t[0]) <= 0xD7A3 for t in kept)


def test_slug_and_url_tail(spark):
    assert values(spark, slug, "My Top List") == ["my_top_list"]
    assert values(spark, url_tail, "http://h/p/ID?si=1", "ID", "http://h/") == ["ID", "ID", ""]


def share(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return 1 - row[-1] / max(len(a), len(b)) if a and b else 0.0


@pytest.mark.parametrize("direct, cost", [(2_000, 2), (7, 1_000_000), (0, 0)])
@pytest.mark.parametrize("least", [0.5, 0.7, 0.9])
def test_similar_titles_finds_every_pair(spark, monkeypatch, least, direct, cost):
    """In blocks whose titles all meet, in pieces, and by rare chunks."""
    monkeypatch.setattr(L, "DIRECT", direct)
    monkeypatch.setattr(L, "CHUNK_COST", cost)
    rng = random.Random(5)
    titles = ["colour my world", "color my world", "hello", "hallo", "song 2", "song two", "a", "b", "ab", "", "aaaaaaaa", "aaaaaaaaaa", "love " * 9]
    for _ in range(120):
        base = list(rng.choice(titles) or "x")
        for _ in range(rng.randrange(4)):
            base[rng.randrange(len(base)) :][:1] = []
            base.insert(rng.randrange(len(base) + 1), rng.choice("abc o"))
        titles.append("".join(base))
    titles = sorted(set(titles))
    asked = spark.createDataFrame([("x", t) for t in titles[::2]] + [("y", "love")], "artist_key string, title_key string")
    offered = spark.createDataFrame([("x", t) for t in titles] + [("y", "you")], "artist_key string, title_key string")
    got = {(r.artist_key, r.title_key, r.found_key): r.title_sim for r in L.similar_titles(asked, offered, least).collect()}
    want = {(p.artist_key, p.title_key, q.title_key): share(p.title_key, q.title_key) for p in asked.collect() for q in offered.collect() if p.artist_key == q.artist_key}
    assert got == pytest.approx({k: v for k, v in want.items() if v >= least})


@pytest.mark.parametrize("cost", [2, 0])
def test_joined_rows_grow_with_the_matches(spark, monkeypatch, cost):
    """Titles of four words under one artist: what leaves the join is no more than a few times the pairs that are similar."""
    monkeypatch.setattr(L, "CHUNK_COST", cost)
    monkeypatch.setattr(L, "DIRECT", 300)
    left_joins, join = [], L._joined

    def watched(*given):
        left_joins.append(join(*given))
        return left_joins[-1]

    monkeypatch.setattr(L, "_joined", watched)
    rng, words = random.Random(1), ["love", "night", "river", "dream", "stone", "fire", "winter", "shadow", "golden", "heart", "moon", "blue", "lost", "city", "wild"]
    titles = list(dict.fromkeys(" ".join(rng.choice(words) for _ in range(4)) for _ in range(2_100)))
    shares = []
    for n in (500, 2_000):
        one = spark.createDataFrame([("x", t) for t in titles[:n]], "artist_key string, title_key string").repartition(4)
        left_joins.clear()
        got = L.similar_titles(one, one, 0.7).collect()
        shares.append(sum(j.count() for j in left_joins) / len(got))
        few = set(titles[:20])
        assert {(r.title_key, r.found_key) for r in got if r.title_key in few} == {(a, b) for a in few for b in titles[:n] if share(a, b) >= 0.7}
    assert max(shares) <= 9 and shares[1] < 1.3 * shares[0]  # a pair meets through nine chunks at most


def catalogue(spark, *tracks):
    return spark.createDataFrame([(i, n, "X", "AR", "al" + a, a, "album", d) for i, n, a, d in tracks], CATALOGUE)


def linked(spark, source, cat):
    src = spark.createDataFrame([(i, n, "x", a, d) for i, n, a, d in source], SOURCE)
    return {r.import_id: r for r in L.link(src, cat).collect()}


def test_gates_and_score(spark):
    cat = catalogue(spark, ("t1", "Night Rain", "Blue", 200_000), ("t2", "Night Rain", "Red", 203_000), ("t3", "Night Rain Song", "Blue", 260_000))
    got = linked(spark, [
        (1, "Night Rain (2011 Remaster)", "Blue (Deluxe)", 204_000),  # album wins over the closer duration
        (2, "Night Rain", None, 203_500),  # without an album the tighter duration decides, t1 first on a tie
        (3, "Night Rain", "Zzzz", 215_000),  # foreign album and not within five seconds
        (4, "Night Rain", "Zzzz", 203_000),  # foreign album, but tight
        (5, "Night Rain", "Blue", 500_000),  # too far
        (6, "Other Thing", "Blue", 200_000),
        (7, "Night Rain", "Blue", None),
    ], cat)
    assert {k: r.matched_track_id for k, r in got.items()} == {1: "t1", 2: "t1", 4: "t1", 7: "t1"}
    assert got[1].score == pytest.approx(0.75 + 0.2 + 0.05) and got[7].score == pytest.approx(0.95)


def test_search_keeps_ten_and_prefers_the_album(spark):
    cat = catalogue(spark, *[(f"t{i:02}", "Same Song", "Other", 1000) for i in range(40)], *[(f"z{i:02}", "Same Song", "Mine", 1000) for i in range(15)])
    keyed = L.with_keys(cat, "name", "artist", "album_name")
    asked = L.with_keys(spark.createDataFrame([(1, "same song", "x", "mine", 1), (2, "same song", "x", "", 1)], SOURCE), "name", "artist_name", "album_name")
    found = L.search(asked, keyed)
    assert rows(found.filter("album_key = 'mine'"), "position", "id") == sorted([(i + 1, f"z{i:02}") for i in range(10)], key=lambda r: str(r[0]))
    assert [r[1] for r in sorted(rows(found.filter("album_key = ''"), "position", "id"))] == [f"t{i:02}" for i in range(10)]


def test_duration_score(spark):
    df = spark.createDataFrame([(0,), (5000,), (12_500,), (20_000,), (None,)], "g int")
    assert [r.s for r in df.select(L.duration_score(F.col("g")).alias("s")).collect()] == [1.0, 1.0, 0.5, 0.0, 0.0]
