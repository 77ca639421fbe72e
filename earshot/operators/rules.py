"""Playlist rules: JSON documents compiled to Columns.

    {"match": "all" | "any", "conditions": [{"field", "operator", "value", "unit"} | nested group],
     "sort": [{"by", "direction"}], "limit": n}

A condition that cannot be used (unknown field, operator or value) is left out and
reported, never fatal. Values become literals, so a rule cannot inject SQL.
"""

from __future__ import annotations

import datetime
import json
import operator
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.order import asc, desc
from earshot.functions.times import ago, as_ts
from earshot.operators.tracks import BASE_COLUMNS

# What a member is called, how many a rule selects by default, and the
# names that stored rules use for units, sort keys and operators.
URI_PREFIX = "spotify:track:"
DEFAULT_LIMIT = 100
UNITS = ("days", "weeks", "months")
SORT_COLUMNS = {
    "album": "album_name", "artist": "artist", "added": "added_at", "plays": "play_count", "last_played": "last_played_at",
    "album_id": "album_id", "disc_number": "disc_number", "track_number": "track_number", "track": "track_name",
}
#: What a rule may sort by under its own name: every column of a track's facts.
FACTS = frozenset((
    *BASE_COLUMNS, "added_at_est", "library_play_count", "library_play_count_first_played", "library_play_count_last_played", "resume_play_count",
    "skip_play_count", "fuzz_play_count", "fuzz_play_count_first_played", "fuzz_play_count_last_played", "play_count", "first_played_at",
    "first_played_at_est", "last_played_at", "last_played_at_est",
))
MOST_SPAN = 100_000  # of any unit: beyond what a timestamp can be moved by
MOST_ROWS = 2**31 - 1

COMPARE = {"is": operator.eq, "eq": operator.eq, "gt": operator.gt, "lt": operator.lt, "gte": operator.ge, "lte": operator.le, "is_not": operator.ne}


class BadCondition(ValueError):
    pass


#: A rule's test as a tree: a leaf is the text of a condition, a group ("all" or "any", [trees]).
Tree = str | tuple[str, list]


@dataclass
class Rule:
    tree: Tree
    leaves: dict[str, Column]
    sort: tuple[tuple[str, str], ...]
    limit: int
    problems: list[str] = field(default_factory=list)

    @property
    def predicate(self) -> Column:
        return _folded(self.tree, lambda leaves, join: reduce(join, [self.leaves[leaf] for leaf in leaves]))

    def order(self) -> list[Column]:
        keys = [asc(c) if way == "ASC" else desc(c) for c, way in self.sort]
        return [*keys, asc("track_id")]


def _whole(value) -> int:
    try:
        number = int(value)
    except (TypeError, ValueError, OverflowError):
        raise BadCondition(f"not a whole number: {value!r}") from None
    if abs(number) >= 2**63:
        raise BadCondition(f"out of range: {value!r}")
    return number


def _moment(value) -> Column:
    try:
        return as_ts(datetime.datetime.fromisoformat(str(value)).replace(tzinfo=None))
    except ValueError:
        raise BadCondition(f"not a date: {value!r}") from None


def _flag(value) -> Column:
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise BadCondition(f"not true or false: {value!r}")
    return F.lit(text == "true")


def _since(value, unit, as_of) -> Column:
    n, unit = _whole(value), str(unit or "").strip().lower()
    if not 0 <= n <= MOST_SPAN or unit not in UNITS:
        raise BadCondition(f"not a span: {value!r} {unit!r}")
    return ago(as_of, n, unit)


def _contains(column: str, value) -> Column:
    """Case-insensitive LIKE; % and _ in the value keep their wildcard meaning, and a
    backslash takes the next character (at the end of the value, the closing %) as it is."""
    pattern = re.sub(r"\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], f"%{value}%", flags=re.DOTALL)
    return F.like(F.lower(column), F.lower(F.lit(pattern)))


def _pick(table: dict, op):
    if op not in table:
        raise BadCondition(f"operator not supported: {op!r}")
    return table[op]


def condition(spec: dict, as_of) -> Column | None:
    """The predicate of one condition; None when it asks for everything."""
    name, op, value, unit = (spec.get(k) for k in ("field", "operator", "value", "unit"))
    if name == "min_plays":
        return F.col("play_count") >= _whole(value)
    if name == "max_plays":
        return F.col("play_count") <= _whole(value)
    if name == "plays":
        return _pick(COMPARE, op)(F.col("play_count"), F.lit(_whole(value)))
    if name == "added_after":
        return F.col("added_at") >= _moment(value)
    if name == "added_before":
        return F.col("added_at") <= _moment(value)
    if name == "date_added":
        return _pick({k: COMPARE[k] for k in ("gt", "lt", "gte", "lte", "eq")}, op)(F.col("added_at"), _moment(value))
    if name == "added_in_last":
        _pick(dict.fromkeys(("eq", "gte", "lte")), op)
        return F.col("added_at") >= _since(value, unit, as_of)
    if name == "last_played_in_last":
        return _pick({"eq": operator.ge, "is_not": operator.lt}, op)(F.col("last_played_at"), _since(value, unit, as_of))
    if name == "last_played":
        return F.col("last_played_at") >= _moment(value)
    if name == "first_played":
        return F.col("first_played_at") >= _moment(value)
    if name in ("is_liked", "is_playable"):
        return F.col(name) == _flag(value)
    if name in ("artist", "album", "track"):
        return _contains({"artist": "artist", "album": "album_name", "track": "track_name"}[name], value)
    if name == "track_source":
        compare, source = _pick({"eq": operator.eq, "is_not": operator.ne}, op), str(value or "").strip().lower()
        if source in ("", "both", "all", "any"):
            return None
        if source not in ("library", "non_library"):
            raise BadCondition(f"not a source: {value!r}")
        return compare(F.col(name), F.lit(source))
    if name == "library_origin":
        return _pick({"eq": operator.eq, "is_not": operator.ne}, op)(F.col(name), F.lit(str(value)))
    raise BadCondition(f"unknown field: {name!r}")


def _objects(spec: dict, name: str) -> list[dict]:
    found = spec.get(name, [])
    if not isinstance(found, list) or not all(isinstance(x, dict) for x in found):
        raise ValueError(f"{name} must be a list of objects")
    return found


def _folded(tree: Tree, test) -> Column:
    """A tree as a predicate; `test` makes one of the leaves of a group and how they are joined."""
    if isinstance(tree, str):
        return test([tree], operator.and_)
    kind, members = tree
    join = operator.and_ if kind == "all" else operator.or_
    leaves = [m for m in members if isinstance(m, str)]
    return reduce(join, [*([test(leaves, join)] if leaves else []), *[_folded(m, test) for m in members if not isinstance(m, str)]])


def _group(spec: dict, as_of, problems: list[str], leaves: dict[str, Column]) -> Tree | None:
    parts = []
    for item in _objects(spec, "conditions"):
        try:
            if "conditions" in item:
                part = _group(item, as_of, problems, leaves)
            else:
                found, part = condition(item, as_of), None
                if found is not None:
                    part = json.dumps([item.get(k) for k in ("field", "operator", "value", "unit")], default=str)
                    leaves[part] = found
        except BadCondition as bad:
            problems.append(f"{item.get('field')}: {bad}")
            continue
        if part is not None:
            parts.append(part)
    return ("all" if spec.get("match", "all") == "all" else "any", parts) if parts else None


class Bits:
    """The distinct conditions of many rules as bits of a track's bitmap. A rule tests groups of them by mask,
    so a condition that a thousand rules share is evaluated once. A condition that is neither true nor false is not
    met: rules have no negation, so that changes no rule's outcome."""

    WORD = 62

    def __init__(self, rules: list[Rule]):
        self.leaves = {leaf: column for rule in rules for leaf, column in rule.leaves.items()}
        self.place = {leaf: divmod(i, self.WORD) for i, leaf in enumerate(self.leaves)}
        self.words = range(-(-len(self.leaves) // self.WORD))

    def columns(self) -> dict[str, Column]:
        """The words of the bitmap, by name."""
        bit = lambda leaf: F.when(self.leaves[leaf], F.lit(1 << self.place[leaf][1]).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        return {f"_bits{w}": reduce(Column.bitwiseOR, [bit(leaf) for leaf, (word, _) in self.place.items() if word == w]) for w in self.words}

    def test(self, rule: Rule) -> Column:
        """Whether a track's bitmap meets a rule."""

        def masked(leaves, join):
            masks: dict[int, int] = {}
            for leaf in leaves:
                word, bit = self.place[leaf]
                masks[word] = masks.get(word, 0) | 1 << bit
            met = [(F.col(f"_bits{w}").bitwiseAND(F.lit(m).cast("bigint")), m) for w, m in masks.items()]
            return reduce(join, [got == m if join is operator.and_ else got != 0 for got, m in met])

        return _folded(rule.tree, masked)


def _sort_keys(spec: dict, problems: list[str]) -> list[tuple[str, str]]:
    sort = []
    for key in _objects(spec, "sort") if isinstance(spec.get("sort"), list) else []:
        by, way = key.get("by", "play_count"), key.get("direction", "desc")
        if not isinstance(by, str) or not isinstance(way, str):
            raise ValueError("sort keys and directions must be text")
        column = SORT_COLUMNS.get(by, by if by in FACTS else None)
        if column is None:
            problems.append(f"sort: unknown key {by!r}")
        elif way.upper() in ("ASC", "DESC"):
            sort.append((column, way.upper()))
    return sort


def compile_rule(document: dict | str, as_of) -> Rule:
    """Guards apply to the whole rule: not excluded, and playable unless a top-level
    condition names `is_playable`.

    A condition that cannot be used is left out and listed in `problems`. A document that
    is no rule (not JSON, not an object, lists or the limit of another kind) raises
    ValueError.
    """
    try:
        spec = json.loads(document) if isinstance(document, str) else document
        if not isinstance(spec, dict):
            raise ValueError("a rule must be an object")
        problems: list[str] = []
        leaves: dict[str, Column] = {}
        wanted = _group(spec, as_of, problems, leaves)
    except json.JSONDecodeError as bad:
        raise ValueError("the rule is not valid JSON") from bad
    except RecursionError:
        raise ValueError("the rule is nested too deeply") from None
    guards = {"guard: not excluded": ~F.col("excluded")}
    if "is_playable" not in [c.get("field") for c in _objects(spec, "conditions")]:
        guards["guard: playable"] = F.col("is_playable")
    sort = _sort_keys(spec, problems)
    try:
        limit = int(spec.get("limit", DEFAULT_LIMIT))
    except (TypeError, OverflowError) as bad:
        raise ValueError(f"not a limit: {spec['limit']!r}") from bad
    if limit < 0:
        raise ValueError("the limit must not be negative")
    tree = ("all", [*([] if wanted is None else [wanted]), *guards])
    return Rule(tree, leaves | guards, tuple(sort) or (("play_count", "DESC"),), min(limit, MOST_ROWS), problems)


def uri(prefix: str = URI_PREFIX) -> Column:
    return F.concat(F.lit(prefix), F.col("track_id"))


def select_by_rule(unified: DataFrame, document: dict | str, as_of) -> DataFrame:
    """The selected tracks in order: a filter and a distributed top-k."""
    rule = document if isinstance(document, Rule) else compile_rule(document, as_of)
    return unified.filter(rule.predicate).orderBy(*rule.order()).limit(rule.limit)
