"""Cheapest repair of a conversation's structure, by auctions on its edit lattice.

A node of the lattice is a place between turns and what was written before it: nothing, a system, a user or an assistant
turn. Arcs are edits: keep a turn, give it the role that fits, delete it, or insert an empty turn that fits. Costs are
whole numbers. A path of edits is grown from each node in turn, the last place first: it extends along the arc that is
cheapest by cost and price of its end, or, if its last node's price is below that, raises the price and
contracts. When it reaches a place whose prices have converged, its own have too, so the next auction ends there. At
last an arc lies on a cheapest path if it is tight (price = cost + price of its end), and of the tight arcs the path
takes those with the least letters. An auction depends on the turn and on the differences of the next prices only, so
its outcome is remembered: a turn costs one lookup.

Turns are range-partitioned by conversation and turn. A conversation that lies inside a partition is repaired there;
one over an edge meets in one place; one too long to be held, or over several edges, goes through joins by place, and only one letter per
turn of it ever meets.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import counted, text_batches, trim
from earshot.operators.digest import ordered_digest
from earshot.operators.ordered import positions
from earshot.sources.snapshots import settle

SPACES = " \t\n\x0b\f\r"
HELD_CHARS = 4 << 20  # of one conversation that is repaired in one place
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
WRITTEN = {USER: "user", ASSISTANT: "assistant"}
FITS = (USER, USER, ASSISTANT, USER)  # the user or assistant turn that may follow
KEEPS = ({NOTHING: SYSTEM}, {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})  # by initial s, u, a, other
#: A turn as one letter: four times its fault, and its role's initial.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS, LETTER_0, END = "sua", 65, 16
FOLLOWING = {(0, 1), (1, 2), (2, 1)}  # initials that may stand side by side
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3


def _arcs(turn: int) -> list[list[tuple[str, int, bool, int]]]:
    """For each node of a place the arcs (letter, cost, into the next place, node there)."""
    fault, initial = divmod(turn, 4)
    more = UNFINISHED if fault == TRUNCATED else 0
    found = []
    for node in range(4):
        arcs = [("I", INSERT, False, FITS[node])]
        if turn == END:
            arcs += [("", 0, True, 0)] if node in (NOTHING, ASSISTANT) else []
        else:
            arcs.append(("D", DELETE, True, node))
            if fault in (SOUND, TRUNCATED):
                arcs.append(("R", REROLE + more, True, FITS[node]))
                arcs += [("K", KEEP + more, True, KEEPS[initial][node])] if node in KEEPS[initial] else []
        found.append(sorted(arcs))
    return found


ARCS = [_arcs(turn) for turn in range(END + 1)]


def auction(turn: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int, tuple]:
    """Converged prices of a place before `turn`, given those `after` it: (prices less the least, the least, and for each
    node its tight arc of the least letter)."""
    arcs, price = ARCS[turn], [min(after)] * 4
    value = lambda arc: arc[1] + (after if arc[2] else price)[arc[3]]
    for origin in range(4):
        path = [origin]
        while True:
            node = path[-1]
            best = min(arcs[node], key=value)
            if price[node] < value(best):
                price[node] = value(best)
                if len(path) > 1:
                    path.pop()
            elif best[2]:
                break
            else:
                path.append(best[3])
    tight = tuple(next(arc for arc in arcs[node] if value(arc) == price[node]) for node in range(4))
    least = min(price)
    return tuple(p - least for p in price), least, tight


_KNOWN: dict[tuple, int] = {}
_OUTCOMES: list[tuple] = []


def _outcome(turn: int, after: tuple[int, ...]) -> int:
    key = (turn, after)
    if key not in _KNOWN:
        _OUTCOMES.append(auction(turn, after))
        _KNOWN[key] = len(_OUTCOMES) - 1
    return _KNOWN[key]


def cheapest(turns: bytes) -> tuple[int, Iterator[tuple[int, str, int]]]:
    """The least cost, and the edits (place, letter, node they lead to) of the cheapest path with the least letters."""
    after, cost, places = (0, 0, 0, 0), 0, array("H")
    for letter in chain([END + LETTER_0], reversed(turns)):
        places.append(_outcome(letter - LETTER_0, after))
        after, least, _ = _OUTCOMES[places[-1]]
        cost += least

    def edits():
        node = NOTHING
        for place in range(len(places)):
            tight = _OUTCOMES[places[-1 - place]][2]
            ahead = False
            while not ahead:
                letter, _, ahead, node = tight[node]
                if letter:
                    yield place, letter, node

    return cost + after[NOTHING], edits()


def counts(turns: bytes) -> list[int]:
    """blank, duplicate, truncated, illegal."""
    faults = [sum(turns.count(LETTER_0 + fault * 4 + k) for k in range(4)) for fault in (BLANK, DUPLICATE, TRUNCATED)]
    pairs = ((turns[i : i + 1], turns[i + 1 : i + 2]) for i in range(len(turns) - 1))
    return [*faults, sum(((a[0] - LETTER_0) % 4, (b[0] - LETTER_0) % 4) not in FOLLOWING for a, b in pairs)]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, lost: the rows of `conversations`, damaged by crc32 of `conv_id:turn` modulo 20.

    0 loses the row, 1 empties its text, 2 takes full stops, exclamation and question marks out of it, 3 repeats the row, 4 makes its role user. Null
    roles and texts are one space; in the key a null is one space, too.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", F.when(how == 4, "user").otherwise(space("role")).alias("role"),
        F.when(how == 1, "").when(how == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text")).alias("text"),
        (how == 0).alias("lost"), F.when(how == 3, 2).otherwise(1).alias("times"),
    )
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def _letter(role: Column, text: Column) -> Column:
    """The letter of a turn that repeats none."""
    bare = F.rtrim(text, F.lit(SPACES))
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    initial = F.substring(role, 1, 1)
    return (fault * 4 + F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)).cast("int")


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
NAMES = [c.split()[0] for c in REPORT.split(", ")]
ROW = "turn long, tie long, role string, text string, letter int"


def _report(rows: list[tuple]) -> list:
    """Of a conversation's rows (turn, role, text, letter) in order."""
    turns, seen = bytearray(), set()
    for _, role, text, letter in rows:
        again = (role, text) in seen and letter // 4 != BLANK
        turns.append(LETTER_0 + (DUPLICATE * 4 + letter % 4 if again else letter))
        seen.add((role, text))
    cost, edits = cheapest(bytes(turns))
    audit, whole, first = [], hashlib.sha256(), True
    for place, letter, node in edits:
        audit.append(letter)
        if letter != "D":
            role = rows[place][1] if letter == "K" else WRITTEN[node]
            whole.update(f"{'' if first else chr(10)}{role}:{'' if letter == 'I' else rows[place][2]}".encode())
            first = False
    numbers = {t for t, *_ in rows if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return [gaps, *counts(bytes(turns)), cost, "".join(audit), whole.hexdigest()]


def _in_place(rows: DataFrame, edges: bool) -> DataFrame:
    """conv_id and its report for conversations that can be repaired where they lie, or their rows as they are, with `part` and `long`.

    `rows` are sorted by conversation and order. With `edges` a partition's first and last conversation may go on elsewhere.
    A conversation whose rows are all lost has an empty report.
    """
    key = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *NAMES, "turn", "tie", "role", "text", "letter", "lost", "part", "long"]

    def run(batches):
        kind, at, begun, held, size, whole, long = None, None, False, [], 0, not edges, False
        read, left, part = [], [], TaskContext.get().partitionId()
        types = [pa.int64()] * 6 + [pa.string(), pa.string()] + [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.bool_()]

        def emit():
            full = [[*r, *[None] * 8] for r in read] + [[r[0], *[None] * 8, *r[1:]] for r in left]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*full), [kind, *types])], names=names)

        def hand_on():
            left.extend([[at, *r, False, part, long] for r in held] or [[at, None, None, None, None, None, True, part, long]])

        for batch in chain(text_batches(batches, 4), [None]):
            for conv, turn, tie, role, text, letter, lost in [] if batch is None else zip(*[c.to_pylist() for c in batch.columns]):
                kind = kind or batch.schema.types[0]
                if not begun or conv != at:
                    if begun and whole:
                        read.append([at, *_report([(r[0], *r[2:]) for r in held])])
                    elif begun and (held or not long):
                        hand_on()
                    whole = begun or not edges
                    at, begun, held, size, long = conv, True, [], 0, False
                if not lost:
                    held.append((turn, tie, role, text, letter))
                    size += len(role) + len(text) + 64
                    if edges and size > HELD_CHARS:
                        whole, long = False, True
                        hand_on()
                        held, size = [], 0
                if len(read) > 5_000 or len(left) > 5_000 or (left and long):
                    yield emit()
                    read, left = [], []
        if begun and whole and not edges:
            read.append([at, *_report([(r[0], *r[2:]) for r in held])])
        elif begun and (held or not long):
            hand_on()
        if read or left:
            yield emit()
        trim()

    return rows.mapInArrow(run, f"conv_id {key}, {REPORT}, {ROW}, lost boolean, part long, long boolean")


def repair(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", lost: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are ordered by `turn` (an integer, null first), ties by a hash of role and text; rows that repeat stay side by side. A turn's first
    fault counts: blank (nothing but white space), duplicate (role and text seen earlier), truncated (last character other than white space
    is no full stop, exclamation or question mark). Keeping a turn costs 0, a new role 3, deleting 4 (a must for blank and duplicate ones),
    inserting an empty user or assistant turn 3, and a truncated turn that stays 3 more. The repaired roles' initials are nothing, or
    user and assistant in turn after at most one system turn. audit: the letters K, R, D, I of the cheapest edits, the least of several. repaired_sha256: of
    the repaired `role:text`, joined by newlines. gaps: turn numbers missing between the least and the greatest. illegal: neighbours whose initials are none of su, ua, au.

    A null role or text counts as one space, as in `damaged`. A role's initial is its first character, so an empty role can only be replaced or deleted. Rows without conv_id
    are one conversation. Rows where the column `lost` is true only name their conversation; one without other rows has zeros and an empty audit. No rows give no rows.
    """
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    gone = F.coalesce(F.col(lost), F.lit(False)) if lost else F.lit(False)
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.xxhash64(of(role), of(text)).alias("tie"),
        F.when(~gone, of(role)).alias("role"), F.when(~gone, of(text)).alias("text"), _letter(of(role), of(text)).alias("letter"), gone.alias("lost"),
    )
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "tie")]
    first = settle(_in_place(rows.repartitionByRange(*keys).sortWithinPartitions(*keys), True), "repaired")
    report = first.filter("cost IS NOT NULL").select("conv_id", *NAMES)
    rest = first.filter("cost IS NULL")

    # over several edges, or too long for one place: at most one conversation for every HELD_CHARS and partition
    named = F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")
    pieces = rest.groupBy("conv_id").agg(F.max("long").alias("long"), F.countDistinct("part").alias("parts"))
    spread = settle(pieces.filter("long OR parts > 2").select(named.alias("named")), "spread")
    rest = rest.withColumn("named", named)
    near = rest.join(counted(spread), "named", "left_anti").select("conv_id", "turn", "tie", "role", "text", "letter", "lost")
    near = near.repartition("conv_id").sortWithinPartitions(*keys)
    report = report.unionByName(_in_place(near, False).select("conv_id", *NAMES))
    if spread.isEmpty():
        return report
    return report.unionByName(_spread_out(rest.join(counted(spread), "named", "left_semi").filter("NOT lost")))


def _spread_out(rows: DataFrame) -> DataFrame:
    """The reports of conversations of any length."""
    rows = rows.select(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id").alias("named"), "turn", "tie", "role", "text", "letter")
    rows = rows.withColumn("conv", F.sha2(F.concat(F.col("named.none").cast("string"), F.coalesce(F.col("named.conv_id").cast("string"), F.lit(""))), 256))
    ids = rows.groupBy("conv").agg(F.first("named").alias("named"))
    placed = settle(positions(rows.drop("named"), ["conv"], [F.col("turn").asc_nulls_first(), F.col("tie")], name="at"), "placed")

    told = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    firsts = placed.select("conv", "at", told.alias("told")).groupBy("conv", "told").agg(F.min("at").alias("at")).select("conv", "at", F.lit(True).alias("new"))
    short = placed.select("conv", "at", "letter").join(firsts, ["conv", "at"], "left")
    blank = F.floor(F.col("letter") / 4) == BLANK
    letter = F.when(F.col("new").isNull() & ~blank, DUPLICATE * 4 + F.col("letter") % 4).otherwise(F.col("letter"))
    short = short.select("conv", "at", F.char(letter + LETTER_0).alias("letter"))
    joined = lambda df, by, at: df.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, "letter"))), lambda x: x["letter"]), "").alias("letter"))
    pieces = joined(short.withColumn("piece", F.shiftright("at", 14)), ["conv", "piece"], "at")
    letters = settle(joined(pieces, ["conv"], "piece"), "letters")  # one letter per turn

    def audits(batches):
        for batch in batches:
            for conv, turns in zip(*[c.to_pylist() for c in batch.columns]):
                cost, edits = cheapest(turns.encode())
                audit = "".join(letter for _, letter, _ in edits)
                yield pa.RecordBatch.from_pylist([dict(zip(["conv", *NAMES[1:7]], [conv, *counts(turns.encode()), cost, audit]))])

    def edit_rows(batches):
        names = ["conv", "at", "sub", "edit", "node"]
        for batch in batches:
            for conv, turns in zip(*[c.to_pylist() for c in batch.columns]):
                done, types = [], [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                for sub, (place, letter, node) in enumerate(cheapest(turns.encode())[1]):
                    if letter != "D":
                        done.append([conv, place + 1, sub, letter, WRITTEN.get(node)])
                    if len(done) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
                        done = []
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    numbers = letters.mapInArrow(audits, "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    edits = letters.mapInArrow(edit_rows, "conv string, at long, sub long, edit string, node string")
    kept = edits.filter("edit <> 'I'").join(placed.select("conv", "at", "role", "text"), ["conv", "at"])
    kept = kept.select("conv", "at", "sub", F.concat(F.when(F.col("edit") == "K", F.col("role")).otherwise(F.col("node")), F.lit(":"), F.col("text")).alias("line"))
    lines = kept.unionByName(edits.filter("edit = 'I'").select("conv", "at", "sub", F.concat("node", F.lit(":")).alias("line")))
    digests = ordered_digest(lines, ["conv"], ["at", "sub"], "line", sep="\n").select("conv", F.col("digest"))
    turns = placed.filter("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("one")).alias("gaps"))
    out = numbers.join(ids, "conv").join(gaps, "conv", "left").join(digests, "conv", "left")
    none = F.sha2(F.lit(""), 256)
    return out.select("named.conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), *NAMES[1:7], F.coalesce("digest", none).alias("repaired_sha256"))
