"""Record linkage: find the catalogue track for an imported one.

A search (what would be ten results of a catalogue query) and a score over its results.
The search is by distinct query text, not by row, and never pairs up a whole group:

* titles of one artist meet in blocks of fitting length, in large blocks only through rare
  pieces, and a pair leaves the join only if it passes the similarity gate; none that does is lost;
* the ten best of a title are found once, whatever the album; a query adds the first ten
  on its own album, and the two together contain its ten best.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions.order import asc
from earshot.functions.text import fold_accents, norm_album, norm_title
from earshot.operators.ordered import above
from earshot.operators.skew import lookup_join, small
from earshot.sources.snapshots import settle

QUERY = ["artist_key", "title_key", "album_key"]
PAIR = ["artist_key", "title_key", "found_key"]
BLOCK = ["artist_key", "band"]
DIRECT = 2_000  # titles of one artist and length band that all meet
CHUNK_COST = 2  # of a pair that meets through a chunk, in pairs that meet directly
REPEATS = 4  # of a letter that count
LETTER_WORDS, PAIR_WORDS = 2, 4  # 64 bits each


@dataclass(frozen=True)
class Tuning:
    title_min: float = 0.70
    album_min: float = 0.35
    far_ms: int = 20_000
    tight_ms: int = 5_000
    title_weight: float = 0.75
    album_weight: float = 0.20
    duration_weight: float = 0.05
    results: int = 10  # results of one search


def with_keys(rows: DataFrame, title: str, artist: str, album: str) -> DataFrame:
    artist_key = F.trim(F.lower(fold_accents(F.col(artist))))
    return rows.withColumns({"title_key": norm_title(F.col(title)), "artist_key": artist_key, "album_key": norm_album(F.col(album))})


def edit_share(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 if a text is empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), 1 - F.levenshtein(a, b) / longer).otherwise(F.lit(0.0))


def similar_titles(asked: DataFrame, offered: DataFrame, least: float) -> DataFrame:
    """(artist_key, title_key, found_key, title_sim) of all title pairs of one artist with
    at least the similarity `least`. Both sides are distinct (artist, title).

    Titles meet inside blocks of one artist and fitting length. A pair leaves the join only if
    its lengths, its letters, its letter pairs and at last its edit distance, which stops at
    the edits allowed, let it: what is joined is what is similar. A block of more than DIRECT
    titles is either cut into pieces of that size, each of which meets all asked titles, or, if
    by measured counts fewer pairs then meet, its titles meet through rare chunks (see `_chunks`).
    """
    left = _signed(asked.filter(F.length("title_key") > 0), "title_key", least, "a_")
    left = left.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    right = _signed(offered.filter(F.length("title_key") > 0).withColumnRenamed("title_key", "found_key"), "found_key", least, "b_")
    large = above(right.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("n")), "n", DIRECT)
    if large is None:
        met = _joined(left, right, BLOCK, _close(least))
    else:
        looks, chunks = _chunks(*[side.join(small(large), BLOCK, "left_semi") for side in (left, right)], least)
        ways = settle(_ways(left, right, chunks), "ways")
        left, right = [side.join(small(ways), BLOCK, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1))) for side in (left, right)]
        cut = right.filter("pieces > 0").withColumn("piece", F.pmod(F.xxhash64("found_key"), F.col("pieces")))
        whole = left.filter("pieces > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))
        moved = F.abs(F.col("a_at") - F.col("b_at"))
        allowed = _edits(F.greatest("a_size", "b_size"), least)
        by_chunk = ways.filter("pieces = 0").select(*BLOCK)
        rare = [side.join(small(by_chunk), BLOCK, "left_semi") for side in (looks, chunks)]
        met = _joined(whole, cut, [*BLOCK, "piece"], _close(least)).select(*PAIR)
        met = met.unionByName(_joined(*rare, [*BLOCK, "gram"], (moved <= allowed) & (F.col("b_rank") <= allowed) & _close(least)).select(*PAIR).distinct())
    longer = F.greatest(F.length("title_key"), F.length("found_key"))
    # no filter on the similarity here: Catalyst would move it into the join, in front of the cheap bounds
    return met.select(*PAIR, (1 - F.levenshtein("title_key", "found_key") / longer).alias("title_sim"))


def _edits(longer: Column, least: float) -> Column:
    return F.floor(longer * (1 - least) + 1e-9).cast("int")


def _signed(titles: DataFrame, title: str, least: float, x: str) -> DataFrame:
    """Titles with their band of length and what bounds an edit distance: bitmaps of their letters (each as often as it
    occurs, up to REPEATS times) and of their letter pairs (ends marked)."""
    text, size = F.col(title), F.length(title)
    letters = F.split(text, "")
    often = lambda c: F.least(F.size(F.filter(letters, lambda y: y == c)), F.lit(REPEATS))
    each = F.flatten(F.transform(F.array_distinct(letters), lambda c: F.transform(F.sequence(F.lit(1), often(c)), lambda k: F.xxhash64(c, k))))
    marked = F.concat(F.lit("\x02"), text, F.lit("\x03"))
    pairs = F.transform(F.sequence(F.lit(1), size + 1), lambda i: F.xxhash64(F.substring(marked, i, F.lit(2))))
    band = F.floor(F.log(size) / (-log(least) * (1 + 1e-9))).cast("int")
    bits = {f"{x}letters{w}": _bits(each, LETTER_WORDS, w) for w in range(LETTER_WORDS)} | {f"{x}pairs{w}": _bits(pairs, PAIR_WORDS, w) for w in range(PAIR_WORDS)}
    return titles.select("artist_key", title, band.alias("band"), size.alias(f"{x}size"), *[c.alias(n) for n, c in bits.items()])


def _bits(hashes: Column, words: int, word: int) -> Column:
    """The bits of the hashes that fall into one word of a bitmap."""
    set_bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(h, F.lit(64)).cast("int"))
    mine = lambda h: F.pmod(F.shiftright(h, 6), F.lit(words)) == word
    got = F.aggregate(hashes, F.lit(0).cast("bigint"), lambda got, h: F.when(mine(h), got.bitwiseOR(set_bit(h))).otherwise(got))
    return F.coalesce(got, F.lit(0).cast("bigint"))  # never null, so that no filter computes it once more


def _close(least: float) -> Column:
    """Whether a pair's edit distance can be, and is, within the edits allowed. An edit changes one letter and at most two
    letter pairs of either title, so letters and pairs that one has and the other lacks bound the distance from below."""

    def lacking(kind, words, a, b):
        return reduce(add, [F.bit_count(F.col(f"{a}{kind}{w}").bitwiseAND(F.bitwise_not(f"{b}{kind}{w}"))) for w in range(words)])

    allowed = _edits(F.greatest("a_size", "b_size"), least)
    bounds = [F.abs(F.col("a_size") - F.col("b_size")) <= allowed]
    for kind, words, per_edit in (("letters", LETTER_WORDS, 1), ("pairs", PAIR_WORDS, 2)):
        bounds += [lacking(kind, words, a, b) <= allowed * per_edit for a, b in (("a_", "b_"), ("b_", "a_"))]
    return reduce(and_, [*bounds, F.call_function("levenshtein", F.col("title_key"), F.col("found_key"), allowed) >= 0])


def _joined(left: DataFrame, right: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    right = right.withColumnsRenamed({k: f"b_{k}" for k in keys})
    return left.join(right, reduce(and_, [F.col(k) == F.col(f"b_{k}") for k in keys], condition))


def _chunks(left: DataFrame, right: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Asked titles by their letter pairs (gram, a_at), and offered ones by rare chunks (gram, b_at, b_rank, met).

    A title is cut into chunks of two letters (its end marked), and an edit spoils one at most.
    So of any k + 1 chunks, k the edits allowed, one stands in the other title, moved by no more
    than k letters. A title offers the k + 1 of its chunks that stand in the fewest asked
    titles (`met`), the rarest first; a pair that allows fewer edits needs the first of them only. One
    that has no k + 1 chunks (at a similarity below about 0.68) offers none, and rank is null.
    """
    marked = lambda t: F.concat(t, F.lit("\x03"))
    cut = lambda t, places: F.transform(places, lambda i: F.struct(F.substring(marked(F.col(t)), i, F.lit(2)).alias("gram"), i.alias("at")))
    looks = left.withColumn("_g", F.explode(cut("title_key", F.sequence(F.lit(1), F.col("a_size"))))).select(*left.columns, "_g.gram", F.col("_g.at").alias("a_at"))
    met = looks.groupBy(*BLOCK, "gram").agg(F.count(F.lit(1)).alias("n"))
    chunks = right.select(*BLOCK, "found_key", "b_size", F.explode(cut("found_key", F.sequence(F.lit(1), F.col("b_size"), F.lit(2)))).alias("_g"))
    chunks = lookup_join(chunks.select(*BLOCK, "found_key", "b_size", "_g.gram", F.col("_g.at").alias("b_at")), met, [*BLOCK, "gram"])
    need = _edits(F.floor(F.col("b_size") / least + 1e-9), least) + 1
    rare = chunks.groupBy(*BLOCK, "found_key", need.alias("need")).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("met"), "b_at", "gram"))).alias("gs"))
    picked = rare.select(*BLOCK, "found_key", F.posexplode_outer(F.when(F.size("gs") >= F.col("need"), F.slice("gs", F.lit(1), F.col("need")))).alias("b_rank", "_g"))
    return looks, right.join(settle(picked.select(*BLOCK, "found_key", "b_rank", "_g.gram", "_g.b_at", "_g.met"), "chunks"), [*BLOCK, "found_key"])


def _ways(left: DataFrame, right: DataFrame, chunks: DataFrame) -> DataFrame:
    """For each large block its pieces, or 0 if its titles are to meet through chunks."""
    met = chunks.groupBy(*BLOCK).agg(F.sum("met").alias("met"), F.max(F.col("b_rank").isNull()).alias("none"), F.countDistinct("found_key").alias("n"))
    sides = left.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("asked"))
    pieces = F.ceil(F.col("n") / max(DIRECT, 1))
    cheaper = ~F.col("none") & (F.col("met") * CHUNK_COST < F.col("n") * F.coalesce("asked", F.lit(0)))
    return met.join(sides, BLOCK, "left").select(*BLOCK, F.when(cheaper, 0).otherwise(pieces).cast("bigint").alias("pieces"))


def search(queries: DataFrame, catalogue: DataFrame, tuning: Tuning = Tuning()) -> DataFrame:
    """The best results per distinct query (artist, title, album), with their position:
    by similarity of title, then same album, then id. `catalogue` has keys (see `with_keys`).

    A result off the query's album is among the best of its (artist, title) whatever the
    album, because a preferred album only moves other tracks ahead of it. So the best are
    found once per title, and each query adds the first tracks on its own album.
    """
    asked = settle(queries.select(*QUERY).distinct(), "asked")  # keys are dear to make and read several times
    catalogue = settle(catalogue, "offered")
    pairs = settle(similar_titles(asked.select("artist_key", "title_key").distinct(), catalogue.select("artist_key", "title_key").distinct(), tuning.title_min), "pairs")
    found = catalogue.select("artist_key", F.col("title_key").alias("found_key"), F.col("album_key").alias("found_album"),
                             *[c for c in catalogue.columns if c not in QUERY])

    def first(rows, keys, *order):
        place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        return rows.withColumn("position", place).filter(F.col("position") <= tuning.results)

    firsts = first(found, ["artist_key", "found_key"], asc("id")).drop("position")
    by_title = lookup_join(pairs, firsts, ["artist_key", "found_key"], "inner")
    by_title = first(by_title, ["artist_key", "title_key"], F.desc("title_sim"), asc("id")).drop("position")
    overall = lookup_join(asked, by_title, ["artist_key", "title_key"], "inner")
    on_album = first(found.filter(F.col("found_album") != ""), ["artist_key", "found_key", "found_album"], asc("id")).drop("position")
    matched = lookup_join(asked.filter(F.col("album_key") != ""), pairs, ["artist_key", "title_key"], "inner")
    same_album = lookup_join(matched, on_album.withColumn("album_key", F.col("found_album")), ["artist_key", "found_key", "album_key"], "inner")
    same = (F.col("album_key") == F.col("found_album")) & (F.col("album_key") != "")
    off_album = overall.filter(~F.coalesce(same, F.lit(False)))  # what it has on the album is among the first ten there
    results = off_album.unionByName(same_album.select(*overall.columns))
    return first(results, QUERY, F.desc("title_sim"), F.desc(same), asc("id"))


def duration_score(gap: Column, tuning: Tuning = Tuning()) -> Column:
    span = float(tuning.far_ms - tuning.tight_ms)
    return (
        F.when(gap.isNull() | (gap >= tuning.far_ms), F.lit(0.0)).when(gap <= tuning.tight_ms, F.lit(1.0))
        .otherwise(1.0 - (gap - tuning.tight_ms) / F.lit(span))
    )


def scored(source: DataFrame, results: DataFrame, tuning: Tuning = Tuning()) -> DataFrame:
    """Each source row with the search results of its query, gated and scored. Similarities
    are taken once per query and result, before the rows of the query meet them."""
    compared = results.select(
        *QUERY, "position", "id", *[F.col(c).alias(f"found_{c}") for c in ("name", "artist", "artist_id", "album_id", "album_name", "album_type", "duration_ms")],
        "found_album", "title_sim", edit_share(F.col("album_key"), F.col("found_album")).alias("album_sim"),
    )
    rows = lookup_join(source, compared, QUERY, "inner")
    gap = F.abs(F.col("found_duration_ms") - F.col("duration_ms"))
    tight = F.coalesce(gap <= tuning.tight_ms, F.lit(False))
    album_ok = (F.col("album_key") == "") | (F.col("found_album") == "") | (F.col("album_sim") >= tuning.album_min) | tight
    kept = rows.filter(F.coalesce(gap <= tuning.far_ms, F.lit(True)) & album_ok)
    score = (
        F.col("title_sim") * tuning.title_weight + F.col("album_sim") * tuning.album_weight + duration_score(gap, tuning) * tuning.duration_weight
    )
    return kept.withColumn("score", score)


def best(candidates: DataFrame) -> DataFrame:
    """The best candidate per source row; the earlier search result wins a tie."""
    rest = ["id", "title_sim", "album_sim", *[f"found_{c}" for c in ("name", "artist", "artist_id", "album_id", "album_name", "album_type", "duration_ms")]]
    top = F.min(F.struct((-F.col("score")).alias("less"), "position", *rest)).alias("_b")
    return candidates.groupBy("import_id").agg(top).select("import_id", (-F.col("_b.less")).alias("score"), *[F.col(f"_b.{c}").alias(c) for c in rest])


def link(source: DataFrame, catalogue: DataFrame, tuning: Tuning = Tuning()) -> DataFrame:
    """(import_id, matched_*) for every source row that finds a confident match."""
    asked = with_keys(source, "name", "artist_name", "album_name")
    offered = with_keys(catalogue, "name", "artist", "album_name")
    wanted = asked.select("import_id", "duration_ms", *QUERY)
    chosen = best(scored(wanted, search(wanted, offered, tuning), tuning))
    return chosen.select(
        "import_id", F.col("id").alias("matched_track_id"), F.col("found_name").alias("matched_name"), F.col("found_artist_id").alias("matched_artist_id"),
        F.col("found_duration_ms").alias("matched_duration_ms"), F.col("found_artist").alias("matched_artist_name"),
        F.col("found_album_id").alias("matched_album_id"), F.col("found_album_name").alias("matched_album_name"),
        F.col("found_album_type").alias("matched_album_type"), "score", "title_sim", "album_sim",
    )
