"""The prefix trie of conversations as a burst trie.

A turn becomes an id of 32 bytes (24 of a digest of role and text, 8 with the text's length in bytes) and a conversation
the string of its turns' ids, its path; texts never travel. Equal paths are one suffix with a count. All suffixes
start in one container under the root. A container with too many suffixes bursts: its head becomes a node of the trie
proper (with the turns that all its suffixes share, so that no round is spent on them) and its suffixes move on to one container per next turn
id. What remains are containers of bounded size; they are dealt over shards, sorted, and swept into nodes from
neighbouring paths. The sums of a burst node are those of the containers below it.
"""

from __future__ import annotations

from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import counted, trim
from earshot.operators.digest import ordered_digest
from earshot.sources.snapshots import settle

WIDTH = 32  # bytes of a turn id


def turn_id(role: Column, text: Column) -> Column:
    """24 bytes of the digest of role and text, then the bytes of the text as 8."""
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.unhex(F.substring(F.sha2(told, 256), 1, 48)), F.unhex(F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))


def turn_paths(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, path: for each conversation the ids of its turns, one after the other, in the order of `turn` (null first).

    Null roles and texts count as empty. Rows that tie in `turn` are ordered by id, repeated ones all stay. Rows without
    `conv_id` belong to no conversation and are left out. A conversation takes 32 bytes for each of its turns, whatever its texts.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), turn_id(*filled).alias("id"))
    return rows.groupBy("conv_id").agg(F.expr("listagg(id, X'') WITHIN GROUP (ORDER BY turn NULLS FIRST, id)").alias("path"))


def upto(path: str | Column, depth: Column | int) -> Column:
    """The first `depth` turns of a path."""
    return F.substring(F.col(path) if isinstance(path, str) else path, F.lit(1), F.lit(WIDTH) * depth)


def from_turn(path: str | Column, depth: Column | int) -> Column:
    """A path without its first `depth` turns."""
    path = F.col(path) if isinstance(path, str) else path
    return F.substring(path, F.lit(WIDTH) * depth + 1, F.octet_length(path))


def _distinct(paths: DataFrame) -> DataFrame:
    """path, n, low, ends: each distinct path once, with its conversations' number, smallest id and digest of ids."""
    paths = settle(paths.select("conv_id", "path"), "paths")
    grouped = settle(paths.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low")), "distinct")
    shared = settle(grouped.filter("n > 1").select(F.sha2("path", 256).alias("id")), "shared")
    members = paths.select(F.sha2("path", 256).alias("id"), "conv_id", F.col("conv_id").cast("string").alias("text"))
    digests = ordered_digest(members.join(counted(shared), "id"), ["id"], ["conv_id"], "text", sep=",")
    told = grouped.withColumn("id", F.sha2("path", 256)).join(digests.select("id", "digest"), "id", "left")
    return told.select("path", "n", "low", F.coalesce("digest", F.sha2(F.col("low").cast("string"), 256)).alias("ends"))


def _shared_depth(a: str, b: str, start: str) -> Column:
    """How many turns two paths share that share at least `start`."""
    most = F.least(F.octet_length(a), F.octet_length(b)) / WIDTH
    deeper = F.filter(F.sequence(F.col(start), most.cast("int")), lambda d: upto(a, d) == upto(b, d))
    return F.array_max(deeper)


def _burst(distinct: DataFrame, most: int, most_bytes: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Containers (a suffix per row), the heads of those that burst, and the paths that end at such a head.

    A row is in the container `top`, the first `start` turns of its path; `above` are the depths of the burst heads over
    it and `up` the smallest conversation of the nearest. A round bursts every container above the bounds at once.
    """
    starts = [F.lit(0).alias("start"), F.lit(None).cast("array<int>").alias("above"), F.lit(None).cast(distinct.schema["low"].dataType).alias("up")]
    current = distinct.select(*distinct.columns, F.lit(b"").alias("top"), *starts)
    done, heads, ended = [], [], []
    while True:
        sizes = current.groupBy("top").agg(
            F.count(F.lit(1)).alias("_rows"), F.sum(F.octet_length("path").cast("long") - F.col("start") * WIDTH).alias("_bytes"),
            F.min("path").alias("_a"), F.max("path").alias("_b"), F.sum("n").alias("h_n"), F.min("low").alias("h_low"),
            F.first("start").alias("start"), F.first("above").alias("above"), F.first("up").alias("up"),
        )
        heavy = sizes.filter((F.col("_rows") > most) | ((F.col("_bytes") > most_bytes) & (F.col("_rows") > 1)))
        heavy = settle(heavy.withColumn("to", _shared_depth("_a", "_b", "start")).withColumn("head", upto("_a", F.col("to"))).drop("_a", "_b", "_rows", "_bytes"), "burst")
        if heavy.isEmpty():
            done.append(current)
            break
        heads.append(heavy)
        moved = settle(current.join(counted(heavy.select("top", "to", "h_low")), "top", "left"), "containers")
        done.append(moved.filter("to IS NULL").select(*current.columns))
        here = F.octet_length("path") == F.col("to") * WIDTH
        ended.append(moved.filter(F.col("to").isNotNull() & here).select(F.col("path").alias("head"), "ends"))
        current = moved.filter(F.col("to").isNotNull() & ~here).select(
            *distinct.columns, upto("path", F.col("to") + 1).alias("top"), (F.col("to") + 1).alias("start"),
            F.concat(F.coalesce("above", F.array().cast("array<int>")), F.array("to")).alias("above"), F.col("h_low").alias("up"),
        )
    union = lambda parts: None if not parts else parts[0] if len(parts) == 1 else union([parts[0].unionByName(parts[1]), *parts[2:]])
    return union(done), union(heads), union(ended)


#: Of a node in a sweep.
LOW, N, CHILDREN, LEAVES, SAVED, ENDS, SIZE, WAITING = range(8)


def _sweep(containers: DataFrame) -> DataFrame:
    """The nodes of every container, from its paths in order. A node is complete when a path leaves it; it then waits
    for its parent, whose smallest conversation it names. `top` and `above` stand at the first node of a container."""
    rows = containers.select("top", "path", "n", "low", "ends", "start", "above", "up").repartition("top").sortWithinPartitions("top", "path")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "top", "above"]

    def run(batches):
        types, done, stack, at, last, about = None, [], [], None, b"", None

        def close():
            node = stack.pop()
            node[LEAVES] = node[LEAVES] or 1
            node[SAVED] += (node[N] - 1) * node[SIZE]
            depth = about[0] + len(stack)
            for child in node[WAITING]:
                done.append([child[LOW], depth + 1, node[LOW], *child[N : SIZE], None, None])
            node[WAITING] = []
            if not stack:
                done.append([node[LOW], depth, about[2], *node[N:SIZE], at, about[1]])
                return
            parent = stack[-1]
            parent[LOW] = node[LOW] if parent[LOW] is None else min(parent[LOW], node[LOW])
            parent[N] += node[N]
            parent[CHILDREN] += 1
            parent[LEAVES] += node[LEAVES]
            parent[SAVED] += node[SAVED]
            parent[WAITING].append(node)

        def emit():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=out)

        for batch in chain(batches, [None]):
            if batch is not None and types is None:
                kinds = {f.name: f.type for f in batch.schema}
                types = [kinds["low"], pa.int64(), kinds["low"], *[pa.int64()] * 4, pa.string(), pa.binary(), kinds["above"]]
            for top, path, n, low, ends, start, above, up in [] if batch is None else zip(*[c.to_pylist() for c in batch.columns]):
                if top != at:
                    while stack:
                        close()
                    at, about, last, open_to = top, (start, above, up), b"", start
                else:
                    open_to = start
                    while open_to * WIDTH < len(path) and path[open_to * WIDTH : open_to * WIDTH + WIDTH] == last[open_to * WIDTH : open_to * WIDTH + WIDTH]:
                        open_to += 1
                    while len(stack) > open_to - start + 1:
                        close()
                for depth in range(start + len(stack), len(path) // WIDTH + 1):
                    size = int.from_bytes(path[depth * WIDTH - 8 : depth * WIDTH], "big") if depth else 0
                    stack.append([None, 0, 0, 0, 0, None, size, []])
                node = stack[-1]  # where the path ends: paths differ and prefixes come first, so it is new
                node[LOW], node[N], node[ENDS], last = low, n, ends, path
                if len(done) >= 5_000:
                    yield emit()
                    done.clear()
        while stack:
            close()
        if done:
            yield emit()
        trim()

    key = containers.schema["low"].dataType.simpleString()
    schema = f"conv_id {key}, depth long, parent_conv_id {key}, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, top binary, above array<int>"
    return rows.mapInArrow(run, schema)


def _head_nodes(heads: DataFrame, ended: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes of the heads that burst, with the turns their containers shared, summed up from what lies below."""
    size = lambda d: F.when(d == 0, 0).otherwise(F.conv(F.hex(F.substring("head", d * WIDTH - 7, F.lit(8))), 16, 10).cast("long"))
    saved_from = lambda d: F.aggregate(F.sequence(d, F.col("to")), F.lit(0).cast("long"), lambda s, k: s + (F.col("h_n") - 1) * size(k))
    heads = settle(heads.withColumn("own", saved_from(F.col("start"))), "heads")
    below = nodes.filter("top IS NOT NULL AND above IS NOT NULL").select(F.col("top").alias("at"), "above", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    below = below.union(heads.select("head", "above", F.lit(0).cast("long"), "own").filter("above IS NOT NULL"))
    parts = below.select("at", F.explode("above").alias("d"), (F.element_at("above", -1)).alias("nearest"), "leaves", "saved")
    parts = parts.groupBy(upto("at", F.col("d")).alias("head")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.sum((F.col("d") == F.col("nearest")).cast("long")).alias("children"))
    whole = heads.join(parts, "head").join(ended, "head", "left")
    each = whole.withColumn("depth", F.explode(F.sequence("start", "to")))
    last = F.col("depth") == F.col("to")
    return each.select(
        F.col("h_low").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.when(F.col("depth") == F.col("start"), F.col("up")).otherwise(F.col("h_low")).alias("parent_conv_id"),
        F.col("h_n").alias("n_convs"), F.when(last, F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("saved") + saved_from(F.col("depth"))).alias("saved_tokens"), F.when(last, F.col("ends")).alias("ends"),
    )


def trie_nodes(paths: DataFrame, *, most: int = 2_000, most_bytes: int = 16 << 20) -> DataFrame:
    """One row per distinct prefix of the paths (conv_id, path as `turn_paths` gives them), the root included.

    conv_id: its smallest member, that is conversation that starts with it. depth: its turns. parent_conv_id (root: null).
    n_convs: members. n_children. n_leaves: nodes without children in its subtree, itself included. saved_tokens: over
    its subtree the sum of (n_convs - 1) times the bytes of a node's last text. ends_sha256: digest of the ids of the
    conversations that end here, ascending and comma-joined (none: of the empty string). A container of more than
    `most` suffixes or `most_bytes` bursts; a single suffix never does. No paths: no rows, not even the root.
    """
    containers, heads, ended = _burst(settle(_distinct(paths), "suffixes"), most, most_bytes)
    nodes = settle(_sweep(containers), "nodes")
    found = nodes.drop("top", "above")
    if heads is not None:
        found = found.unionByName(_head_nodes(heads, ended, nodes))
    return found.select(*[c for c in found.columns if c != "ends"], F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def rebuilt_paths(paths: DataFrame, families: int = 5, most: int = 9) -> DataFrame:
    """conv_id, path: conversation c starts with the first h turns of conversation c - c % families (all if fewer, none
    if absent) and goes on with its own turns after its first h; h is crc32 of c as text, modulo `most`."""
    c, h = F.col("conv_id"), (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    paths = settle(paths, "own_paths")
    bases = paths.filter(c % families == 0).select(c.alias("base"), upto("path", most - 1).alias("base_path"))
    joined = paths.withColumn("base", c - c % families).join(bases, "base", "left")
    return joined.select("conv_id", F.concat(upto(F.coalesce("base_path", F.lit(b"")), h), from_turn("path", h)).alias("path"))
