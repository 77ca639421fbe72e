import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from earshot.llm.prefix_trie import rebuilt_paths, trie_nodes, turn_paths
from tests.llm.cases import LONG, table

SCHEMA = "conv_id long, turn long, role string, text string, path string, top string, depth string, n string"


def sequences(rows):
    """conv_id -> its turns in order."""
    found = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            found[r[0]].append(((r[1] is not None, r[1]), (r[2] or "", r[3] or "")))
    return {c: tuple(t for _, t in sorted(v, key=lambda x: x[0])) for c, v in found.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, ())[:h] + turns[h:]
    return out


def brute(seqs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in seqs.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children[p]), leaves[p], saved[p], digest(ends[p])) for p, m in members.items()
    )


def rows_of(nodes):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in nodes.collect())


@pytest.mark.parametrize("limits", [{}, {"most": 1}, {"most": 3}, {"most_bytes": 200}])
def test_rebuilt_conversations(spark, limits):
    """Also with containers of one suffix, so that nearly every node bursts."""
    rows = table(spark, "conversations", "0.01")
    got = rows_of(trie_nodes(rebuilt_paths(turn_paths(rows)), **limits))
    assert got == brute(rebuilt(sequences([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])))


ODD = [
    *[(c, t, "user", f"shared {t}") for c in range(40) for t in range(12)],  # copies, and turns all share
    *[(c, 12 + c % 3, "assistant", f"é {c % 5}") for c in range(40)],
    (100, None, "user", "first"), (100, 0, None, None), (100, 7, "user", LONG), (101, None, "user", "first"), (101, 0, "", ""),
    (102, 1, "user", ""), (103, 5, "user", None), (104, 1, "use", "r"), (105, 1, "user", "r"), (-3, 1, "user", "r"), (106, None, None, None),
    (None, 1, "user", "no conversation"), (107, 0, "user", "same"), (107, 0, "user", "same"), *[(200, t, "user", str(t)) for t in range(500)],
    *[(201 + k, t, "user", str(t)) for k in range(3) for t in range(450 + k)],
]


@pytest.mark.parametrize("limits", [{}, {"most": 2}])
def test_odd_conversations(spark, limits):
    rows = spark.createDataFrame([(*r, "clash", "clash", None, "clash") for r in ODD], SCHEMA).repartition(7)
    paths = turn_paths(rows)
    assert rows_of(trie_nodes(paths, **limits)) == brute(sequences(ODD))
    assert rows_of(trie_nodes(rebuilt_paths(paths), **limits)) == brute(rebuilt_sql(sequences(ODD)))


def rebuilt_sql(own):
    """As `rebuilt`, with the remainder of SQL, which takes the sign of its left side."""
    out = {}
    for c, turns in own.items():
        h, rest = zlib.crc32(str(c).encode()) % 9, (abs(c) % 5) * (-1 if c < 0 else 1)
        out[c] = own.get(c - rest, ())[:h] + turns[h:]
    return out


def test_no_conversations(spark):
    assert rows_of(trie_nodes(rebuilt_paths(turn_paths(spark.createDataFrame([], SCHEMA))))) == []


def test_many_copies_over_many_tasks(spark):
    rows = spark.range(0, 6_000, 1, 16).select(F.col("id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = rows_of(trie_nodes(turn_paths(rows), most=500))
    assert len(got) == 2_002 and got == brute(sequences([tuple(r) for r in rows.collect()]))
