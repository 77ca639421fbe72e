"""Members of every dynamic playlist, and the bookkeeping around them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from earshot.functions.order import asc
from earshot.functions.text import url_tail
from earshot.functions.times import as_ts
from earshot.operators.merge import stamp
from earshot.operators.digest import ordered_digest
from earshot.operators.ordered import positions
from earshot.operators.rules import Bits, Rule, compile_rule, uri
from earshot.operators.skew import fits_broadcast, hot_keys, key_sizes, lookup_join
from earshot.sources.members import MemberTable
from earshot.sources.snapshots import fresh_path, settle

EXCLUSIONS = "exclusions"
BATCH = 100  # members are handed on in batches of this size
LINE = 1_000  # flagged playlists named in one line
TOP_K = 1_000  # up to this limit Spark keeps a top-k per group while it sorts
RULES_PER_SCAN = 200  # rule documents tested in one scan of the tracks
SALTS = 64
MEMBERS, OUTCOME = "rule string, position int, uri string", "rule string, problem string, fatal boolean"
HOT_LISTS = 100  # lists of one rule from which their join is salted


def ranked_members(unified: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """(rule, position, uri) of every rule, whatever their number and sort orders, with one scan of the tracks.

    A track's distinct conditions are evaluated once, as bits, and every rule tests them by mask. Rows of
    different rules carry their sort keys in columns they share, so one window ranks them all. Positions of short
    lists are found in two steps, first per (rule, salt) and then per rule, so a rule that
    matches most of the library never sends more than SALTS x TOP_K rows to one task.
    Lists of over TOP_K are numbered in a distributed sort, of a second scan.
    """
    parts = [_ranked(unified, chosen, short) for short in (True, False) if (chosen := {n: r for n, r in rules.items() if (r.limit <= TOP_K) == short})]
    return reduce(DataFrame.unionByName, parts) if parts else _rows(unified.sparkSession, [], MEMBERS)


def _ranked(unified: DataFrame, rules: dict[str, Rule], short: bool) -> DataFrame:
    bits, listed = Bits(list(rules.values())), list(rules.values())
    keys, order = _shared_order(dict(unified.dtypes), listed)
    hits = F.filter(F.array(*[F.when(bits.test(r), F.lit(i)) for i, r in enumerate(listed)]), lambda x: x.isNotNull())
    tracks = unified.withColumns(bits.columns())
    rows = tracks.withColumn("_rule", F.explode(hits)).select("_rule", "track_id", *[c.alias(n) for n, c in keys.items()])
    if short:
        most = max(r.limit for r in listed)
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("track_id"), F.lit(SALTS)))
        near = rows.withColumn("_r", F.row_number().over(W.partitionBy("_rule", "_salt").orderBy(*order))).filter(F.col("_r") <= most)
        ranked = near.withColumn("position", F.row_number().over(W.partitionBy("_rule").orderBy(*order))).filter(F.col("position") <= most)
    else:
        ranked = positions(rows, ["_rule"], order)
    names = _rows(unified.sparkSession, [(i, n, r.limit) for i, (n, r) in enumerate(rules.items())], "_rule int, rule string, cap long")
    named = ranked.join(F.broadcast(names), "_rule").filter(F.col("position") <= F.col("cap"))  # a page of rules
    return named.select("rule", F.col("position").cast("int").alias("position"), uri().alias("uri"))


def _shared_order(types: dict[str, str], rules: list[Rule]) -> tuple[dict[str, Column], list[Column]]:
    """Columns that hold the sort keys of rows of different rules, and the order by them that is each rule's own.

    At each place of a sort a row has a flag that says where its null goes, and its key as a whole number, a real
    number (both turned round to descend), or a text that ascends or one that descends; the others are null for all rows of its rule.
    """
    sorts = list(dict.fromkeys(r.sort for r in rules))
    sort_of = F.get(F.array(*[F.lit(sorts.index(r.sort)) for r in rules]), F.col("_rule"))
    keys, order = {}, []
    for place in range(max(map(len, sorts))):
        columns: dict[str, Column] = {}
        for i, sort in enumerate(sorts):
            if place >= len(sort):
                continue
            name, down = sort[place][0], sort[place][1] == "DESC"
            value, mine = F.col(name), sort_of == i
            if types[name] == "string":
                kind = "text_down" if down else "text_up"
            elif types[name] in ("float", "double"):
                kind, value = "real", -value if down else value
            else:
                value = {"date": F.unix_date(value), "timestamp": F.unix_micros(value), "timestamp_ntz": F.unix_micros(value.cast("timestamp"))}.get(types[name], value)
                kind, value = "whole", F.bitwise_not(value.cast("bigint")) if down else value.cast("bigint")
            for k, v in (("flag", F.col(name).isNull() != F.lit(down)), (kind, value)):
                columns[k] = F.when(mine, v) if k not in columns else columns[k].when(mine, v)
        for kind in sorted(columns):  # the flag comes first
            keys[f"_{place}_{kind}"] = columns[kind]
            order.append(F.col(f"_{place}_{kind}").desc() if kind == "text_down" else F.col(f"_{place}_{kind}").asc())
    return keys, [*order, asc("track_id")]


def followed(playlists: DataFrame) -> DataFrame:
    return playlists.filter(F.col("is_dynamic") & (F.col("slug") != EXCLUSIONS))


@dataclass
class RuleRun:
    """What the rule documents in use select, and what was wrong with them."""

    members: DataFrame  # rule, position, uri
    usable: DataFrame  # rule: documents that could be read
    problems: DataFrame  # rule, problem, fatal


def run_rules(unified: DataFrame, playlists: DataFrame, as_of) -> RuleRun:
    """Every distinct rule document in use, compiled and evaluated.

    Documents come to the driver RULES_PER_SCAN at a time, and each page adds its members
    to one written table, so their number has no bound. A document that is no rule leaves
    its playlists as they are and is listed as a fatal problem; a condition that cannot
    be used is listed too.
    """
    spark = unified.sparkSession
    documents = followed(playlists).select(F.coalesce("rules", F.lit("{}")).alias("rule")).distinct()
    path, found = fresh_path(spark, "rules"), False
    for page in _pages((r.rule for r in documents.toLocalIterator()), RULES_PER_SCAN):
        compiled, outcome = {}, []
        for text in page:
            try:
                compiled[text] = compile_rule(text, as_of)
                outcome += [(text, None, False), *[(text, p, False) for p in compiled[text].problems]]
            except ValueError as bad:
                outcome.append((text, str(bad), True))
        ranked_members(unified, compiled).write.mode("append").parquet(f"{path}/members")
        _rows(spark, outcome, OUTCOME).coalesce(1).write.mode("append").parquet(f"{path}/outcome")
        found = True
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}") if found else _rows(spark, [], schema)
    outcome = read("outcome", OUTCOME)
    return RuleRun(read("members", MEMBERS), outcome.filter("problem IS NULL").select("rule"), outcome.filter("problem IS NOT NULL"))


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver's as a relation of the plan itself: no job makes it."""
    fields = to_arrow_schema(StructType.fromDDL(schema))
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(fields), fields)], schema=fields), schema)


def _pages(items, size: int):
    items = iter(items)
    while page := list(islice(items, size)):
        yield page


def all_playlists(unified: DataFrame, playlists: DataFrame, as_of) -> DataFrame:
    """(slug, position, batch, uri). Playlists with equal rules share one selection."""
    lists = followed(playlists).select("slug", F.coalesce("rules", F.lit("{}")).alias("rule"))
    members = run_rules(unified, playlists, as_of).members
    hot = None
    if not fits_broadcast(members):  # every list is multiplied by its members, so a rule is hot long before it has many lists
        hot = settle(hot_keys(key_sizes(lists, ["rule"]), ["rule"], "_n", at_least=HOT_LISTS), "hot_rules")
    joined = lookup_join(lists, members, ["rule"], "inner", spread=F.xxhash64("slug"), hot=hot)
    return joined.select("slug", "position", batch_of(F.col("position")).alias("batch"), "uri")


def write_members(members: DataFrame, path: str, decided: DataFrame | None = None) -> MemberTable:
    """The members of `all_playlists` into the table at `path`, which is made if there is none. A playlist that is written
    replaces its former members, one that `decided` (slug) names besides becomes empty; others stay."""
    spark = members.sparkSession
    table = MemberTable(spark, path)
    if not table.version():
        return MemberTable.create(spark, path, members)
    table.replace(members, decided)
    return table


def batch_of(position: Column) -> Column:
    return F.floor((position - 1) / BATCH).cast("int")


def tracklist_hashes(members: DataFrame, key: str = "rule") -> DataFrame:
    """SHA-256 of the comma-joined members in order, as the hash of a playlist is defined."""
    hashed = ordered_digest(members, [key], ["position"], "uri", sep=",")
    return hashed.select(key, F.col("digest").alias("new_hash"), F.col("n_items").cast("int").alias("new_count"))


def change_gate(unified: DataFrame, playlists: DataFrame, as_of) -> DataFrame:
    """Playlists after a sync: an unchanged hash only moves the time; an emptied list gets
    count 0 and keeps its hash; a changed one gets hash, count and time. Playlists that
    are not dynamic, or whose rules cannot be read, stay as they are."""
    run = run_rules(unified, playlists, as_of)
    hashes = run.usable.join(tracklist_hashes(run.members), "rule", "left").select(
        "rule", F.coalesce("new_hash", F.sha2(F.lit(""), 256)).alias("new_hash"), F.coalesce("new_count", F.lit(0)).alias("new_count")
    )
    due = F.col("is_dynamic") & (F.col("slug") != EXCLUSIONS)
    key = F.when(due, F.coalesce("rules", F.lit("{}")))
    joined = lookup_join(playlists.withColumn("rule", key), settle(hashes, "hashes"), ["rule"])
    ran = F.col("new_hash").isNotNull()
    same = F.col("last_synced_hash").eqNullSafe(F.col("new_hash"))
    return joined.select(
        *[c for c in playlists.columns if c not in ("last_synced_at", "track_count", "last_synced_hash")],
        F.when(ran, as_ts(as_of)).otherwise(F.col("last_synced_at")).alias("last_synced_at"),
        F.when(ran & ~same, F.col("new_count")).otherwise(F.col("track_count")).alias("track_count"),
        F.when(ran & ~same & (F.col("new_count") > 0), F.col("new_hash")).otherwise(F.col("last_synced_hash")).alias("last_synced_hash"),
        F.when(ran, F.when(same, "unchanged").when(F.col("new_count") == 0, "emptied").otherwise("changed")).alias("outcome"),
    )


def soft_delete(playlists: DataFrame, upstream: DataFrame, as_of, reason: str = "playlist not found in user's library") -> DataFrame:
    """Flag playlists missing upstream and reset those seen. A miss also stamps the last
    look; a playlist that is seen keeps its own."""
    seen_ids = upstream.select(F.col("id").alias("_id")).distinct().withColumn("_seen", F.lit(True))
    joined = playlists.withColumn("_id", url_tail(F.col("playlist_id"))).join(seen_ids, "_id", "left")
    seen, now = F.coalesce("_seen", F.lit(False)), as_ts(as_of)
    changed = {
        "pending_delete": ~seen,
        "missing_count": F.when(seen, 0).otherwise(F.coalesce("missing_count", F.lit(0)) + 1),
        "last_missing_at": F.when(~seen, now),
        "last_missing_reason": F.when(~seen, F.left(F.lit(reason), F.lit(500))),
        "last_seen_at": F.when(seen, F.col("last_seen_at")).otherwise(now),
    }
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in playlists.columns])


def ignore_missing(playlists: DataFrame, slugs: DataFrame) -> DataFrame:
    """Clear the deletion flag of playlists by hand: they count as never missed."""
    none = F.lit(None)
    changes = {"pending_delete": F.lit(False), "missing_count": F.lit(0), "last_missing_at": none, "last_missing_reason": none}
    return stamp(playlists, "slug", slugs.select("slug"), changes)


def delete_candidates(playlists: DataFrame) -> DataFrame:
    """The playlists flagged for deletion, newest miss first, in lines of LINE entries:
    (line, flagged, summary)."""
    flagged = playlists.filter("pending_delete").select("slug", "missing_count", "last_missing_at")
    misses = F.coalesce(F.col("missing_count").cast("string"), F.lit("None"))
    entry = F.concat("slug", F.lit("(misses="), misses, F.lit(")"))
    placed = positions(flagged, [], [F.col("last_missing_at").desc_nulls_last(), F.col("slug")])
    line = F.floor((F.col("position") - 1) / LINE).cast("int").alias("line")
    entries = F.array_sort(F.collect_list(F.struct("position", entry.alias("e"))))
    return placed.groupBy(line).agg(
        F.count(F.lit(1)).alias("flagged"), F.concat_ws(", ", F.transform(entries, lambda x: x["e"])).alias("summary")
    )
