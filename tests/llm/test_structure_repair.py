import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from earshot.llm import structure_repair
from earshot.llm.structure_repair import LETTER_0, cheapest, damaged, repair
from tests.llm.cases import LONG, table
from tests.llm.test_prefix_trie import SCHEMA

SPACES = " \t\n\x0b\f\r"
ROWS = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACES)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """Cost, audit and repaired turns of the cheapest edits, by dynamic programming over all initials written so far."""
    best = {"": (0, "", ())}

    def better(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def inserts(table):
        for _ in range(3):
            for state, (cost, audit, out) in list(table.items()):
                for role in ("user", "assistant"):
                    if re.fullmatch("(s?(ua)*u?)?", state + role[0]):
                        better(table, shorter(state + role[0]), (cost + 3, audit + "I", (*out, (role, ""))))
        return table

    def shorter(state):  # what may follow depends on no more
        return state if len(state) < 4 else state[-2:] if state[-1] == "a" else state[:1] * (state[0] == "s") + "u" if state[-1] == "u" else state

    for (role, text), fault in zip(rows, faults(rows)):
        after = {}
        for state, (cost, audit, out) in inserts(best).items():
            better(after, state, (cost + 4, audit + "D", out))
            more = 3 if fault == "truncated" else 0
            for letter, name, price in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)) if fault in ("", "truncated") else ():
                if name and re.fullmatch("(s?(ua)*u?)?", state + name[0]):
                    better(after, shorter(state + name[0]), (cost + price + more, audit + letter, (*out, (name, text))))
        best = after
    ends = [v for s, v in inserts(best).items() if re.fullmatch("(s?(ua)+)?", s)]
    return min(ends, key=lambda v: v[:2])


def expected(rows, damage):
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text, times = " " if role is None else role, " " if text is None else text, 1
        if damage:
            how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            times, text = [0, 1, 1, 2][how] if how < 4 else 1, "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            role = "user" if how == 4 else role
        kept += [((turn is not None, turn), role, text)] * times
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: r[0])
        numbers = {t for (there, t), *_ in kept if there}
        rows = [r[1:] for r in kept]
        cost, audit, repaired = brute(rows)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        found = [faults(rows).count(k) for k in ("blank", "duplicate", "truncated")]
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out[conv] = (gaps, *found, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def reports(df):
    rows = df.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_every_short_conversation():
    """All ways of up to four turns, by cost and letters."""
    texts = {0: "ok.", 1: " ", 3: "cut"}
    for n in range(5):
        for turns in itertools.product([(f, k) for f in (0, 1, 3) for k in range(4)], repeat=n):
            if n == 4 and sum(f == 1 for f, _ in turns) != 1:
                continue
            rows = [("suat"[k] + "x" * i, texts[f]) for i, (f, k) in enumerate(turns)]  # names differ, so none is a duplicate
            cost, edits = cheapest(bytes(LETTER_0 + f * 4 + k for f, k in turns))
            audit = "".join(letter for _, letter, _ in edits)
            assert (cost, audit) == brute(rows)[:2], turns


def test_long_conversations():
    draw = random.Random(5)
    for _ in range(40):
        turns = [(draw.choice((0, 0, 1, 3)), draw.choice((0, 1, 1, 2, 2, 3))) for _ in range(200)]
        rows = [("suat"[k] + str(i), {0: "ok.", 1: " ", 3: "cut"}[f]) for i, (f, k) in enumerate(turns)]
        cost, edits = cheapest(bytes(LETTER_0 + f * 4 + k for f, k in turns))
        assert (cost, "".join(letter for _, letter, _ in edits)) == brute(rows)[:2]


@pytest.mark.parametrize("bound", [4 << 20, 400])
def test_damaged_table(spark, monkeypatch, bound):
    """Also where most conversations are too long for one place."""
    monkeypatch.setattr(structure_repair, "HELD_CHARS", bound)
    rows = table(spark, "conversations", "0.01").select("conv_id", "turn", "role", "text")
    assert reports(repair(damaged(rows), lost="lost")) == expected([tuple(r) for r in rows.collect()], True)


ODD = [
    (0, None, "user", "first."), (0, 1, "assistant", None), (0, 2, None, "no role."), (0, 3, "assistant", LONG), (1, 1, "user", ""), (2, 1, "", "empty role."), (2, 5, "user", "gap"),
    (3, None, "system", "a."), (3, None, "system", "a."), (4, 1, "user", "same."), (4, 1, "user", "same."), (4, 2, "assistant", "same."), (4, 9, "user", "same."), (4, 12, "assistant", "\x85"),
    (None, 1, "user", "no conversation"), (None, 2, "assistant", "kept!"), (5, 1, "assistant", "end. \t\n"), (5, 2, "system", "?"), (6, -4, "user", "日本。"), (6, 4, "assistant", "é."),
    *[(7, t, ["user", "assistant", "user"][t % 3], f"turn {t % 50}" + "." * (t % 4 > 0)) for t in range(300)], *[(10 + c, 0, "user", "x.") for c in range(60)],
]


@pytest.mark.parametrize("bound", [4 << 20, 300])
@pytest.mark.parametrize("damage", [False, True])
def test_odd_conversations(spark, monkeypatch, bound, damage):
    monkeypatch.setattr(structure_repair, "HELD_CHARS", bound)
    rows = spark.createDataFrame([(*r, "clash", "clash", None, "clash") for r in ODD], SCHEMA).repartition(6)
    got = reports(repair(damaged(rows), lost="lost") if damage else repair(rows))
    assert got == expected(ODD, damage)
    assert not damage or any(v[6] == "" for v in got.values())  # some conversation lost all it had


def test_one_conversation_over_many_tasks(spark):
    rows = spark.range(0, 20_000, 1, 8).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.hash("id") % 2 + 2).cast("int") % 2 + 1).alias("role"), F.concat(F.lit("t"), (F.col("id") % 9_000).cast("string"), F.lit(".")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = reports(repair(rows))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == expected([tuple(r) for r in rows.collect()], False)


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert reports(repair(none)) == {} and reports(repair(damaged(none), lost="lost")) == {}
