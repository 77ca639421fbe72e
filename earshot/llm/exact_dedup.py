"""Exact duplicates, combined in steps that no group of copies can overload.

Texts are equal when identical without white space. Every row first becomes a short row with the digest of its
normalised text. Only digests met more than once can hold copies; their rows are written with their content, and
the content itself is the key of every step: copies are combined inside a task (partial aggregation on digest and
content), then per digest, content and salt, then the salts' winners per digest and content. A text that fills a
third of the table meets the last step as one row per salt, and its rows find their winner without a shuffle.
Different contents with one digest stay apart, as classes of that digest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm import common
from earshot.llm.common import counted, whole_rows
from earshot.sources.snapshots import settle

#: The characters of [\x20\x09-\x0D].
SPACES = " \t\n\x0b\f\r"
SALTS = 64
HOT_ROWS = 100_000  # of a key, in a join that shuffles: some megabytes without the texts


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _winner() -> Column:
    """The row that stays: most code points, then smallest key (null comes last), then smallest row number."""
    rank = F.struct("n_points", F.col("doc_id").isNotNull(), -F.col("doc_id").cast("decimal(38,0)"), -F.col("row"))
    return F.max_by(F.struct("n_points", "doc_id", "row"), rank).alias("best")


def _combined(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, keep_id, keep_row: per task (map side), per salt, then per group. The upper bits of a row number are the task
    that gave it, so the copies a task met share a salt and leave it as one row."""
    salted = rows.groupBy(*keys, F.pmod(F.shiftright("row", 33), F.lit(SALTS)).alias("salt")).agg(F.count(F.lit(1)).alias("n"), _winner())
    whole = salted.select(*keys, "n", "best.*").groupBy(*keys).agg(F.sum("n").alias("n"), _winner())
    return whole.select(*keys, "n", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))


def exact_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", row: str | None = None, digest=sha256) -> DataFrame:
    """Every row of `docs` with its group of equal texts.

    One row per row, dropped ones and repeated ones too: doc_id, keep_id (doc_id of the row that stays, null if
    that row has none), group_size, kept (true for one row of each group, also among rows that repeat a key),
    text_sha256 of the normalised text, row (a number that names the row: column `row` of `docs` if given). Null
    counts as the empty text; all empty texts are one group. Keys are integers. `digest` maps the normalised
    text to the grouping key: a weak one costs time but cannot change the groups. An empty table gives no rows.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), number.alias("row"))
    rows = rows.withColumn("norm", normalised(F.col("text"))).withColumn("n_points", F.char_length("text").cast("long"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    sha = F.col("digest") if digest is sha256 else sha256(F.col("norm"))
    about = ["doc_id", "row", "digest", "n_points", sha.alias("text_sha256")]
    short = settle(rows.select(*about), "digests")
    repeated = settle(short.groupBy("digest").agg(F.count(F.lit(1)).alias("met")).filter("met > 1"), "repeated")
    copies = settle(_looked_up(rows.select(*about, "norm"), repeated, "met", "inner").drop("met"), "copies")
    classes = settle(_combined(copies, ["digest", "norm"]), "classes")
    shared = settle(classes.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"), F.sum("n").alias("met")).filter("contents > 1").drop("contents"), "shared")

    alone = _looked_up(short, repeated, "met", "left_anti")
    decided = [alone.withColumns({"n": F.lit(1).cast("long"), "keep_id": F.col("doc_id"), "keep_row": F.col("row")})]
    if shared.isEmpty():
        decided.append(_looked_up(copies.drop("norm"), classes.drop("norm"), "n", "inner"))
    else:  # one digest for several contents: the rows of that digest find their class by content
        decided.append(_looked_up(copies.drop("norm"), _looked_up(classes.drop("norm"), shared, "met", "left_anti"), "n", "inner"))
        told_apart = [_looked_up(x, shared, "met", "inner").drop("met") for x in (copies, classes)]
        decided.append(told_apart[0].join(told_apart[1], ["digest", "norm"]).drop("norm"))
    kept = F.col("keep_row") == F.col("row")
    out = ["doc_id", "keep_id", F.col("n").alias("group_size"), kept.alias("kept"), "text_sha256", "row"]
    return reduce(DataFrame.unionByName, [d.select(*out) for d in decided])


def _looked_up(rows: DataFrame, found: DataFrame, size: str, how: str) -> DataFrame:
    """`rows` joined (inner or left_anti) with `found`, a written table of a row per digest that says how many of the rows have it.

    No digest's rows meet in one task: `found` is broadcast if counted few, else its digests of HOT_ROWS rows and more
    are, of which there is at most one per HOT_ROWS rows, and only the rest is shuffled.
    """
    if found.count() <= common.BROADCAST_ROWS:
        return rows.join(F.broadcast(found), "digest", how)
    hot = F.broadcast(found.filter(F.col(size) >= HOT_ROWS))
    rest = rows.join(hot, "digest", "left_anti").join(found.filter(F.col(size) < HOT_ROWS), "digest", how)
    return rest if how == "left_anti" else rest.unionByName(rows.join(hot, "digest"))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one per group of equal texts.

    Where every row has a key of its own, the keys of the others are taken out. Else `docs` is written once with
    a row number that the decisions name, so rows that repeat a key and a text, or have no key, lose no more than
    their copies. Both ways keep the same rows.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    groups = settle(exact_groups(docs, doc_id=doc_id, text=text).select("doc_id", "kept"), "groups")
    shared = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("met")).filter("met > 1 OR doc_id IS NULL")
    if shared.isEmpty():
        dropped = settle(groups.filter("NOT kept").select(F.col("doc_id").alias(doc_id)), "dropped")
        return docs.join(counted(dropped), doc_id, "left_anti").select(*columns)
    numbered = settle(docs.select(whole_rows(docs).alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    named = numbered.select(F.col("row"), F.col(f"doc.`{doc_id}`").alias("doc_id"), F.col(f"doc.`{text}`").alias("text"))
    kept = exact_groups(named, row="row").filter("kept").select("row")
    return numbered.join(kept, "row", "left_semi").select("doc.*")
