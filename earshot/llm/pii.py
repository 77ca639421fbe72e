"""Personal data: fixed patterns, and what their contexts reveal.

Emails, IP addresses, card and phone numbers are found by their patterns. They seed a bootstrap: each occurrence
of an identifier-like token (six or more letters, digits, - and _, two digits at least), of a run of such groups
parted by spaces, dots, brackets or slashes (six characters and two digits together) or of a seed is an instance
with the contexts it stands in (the word before, the two words before, the word after). Spark holds the graph of
contexts and instances and scores it in rounds: a context by the mean confidence of its instances, damped for few
of them; an instance by its best context. Seeds keep confidence 1. Tokens that end with enough confidence, in a
context with enough of it, are spans of kind `other`, a run before the tokens in it; spans of the patterns always
stay.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_texts, map_texts, resident
from earshot.sources.snapshots import settle

KINDS = ("email", "ip", "card", "phone")
FOUND = "other"

#: The patterns of the kinds. Each is written so that a failed start is not tried again further on in
#: the same run of characters, which finds the same matches in time linear in the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN_CHAR = re.compile(r"[A-Za-z0-9_-]")
_TOKEN = re.compile(r"[A-Za-z0-9_-]+")
_WORD = re.compile(r"\w+|=")
#: Between two groups of a run: a space, dot or slash, or a bracket; a short group of capitals may stand there, too.
_BLANK = "[ \u00a0\u2009\u202f]"
_PART = rf"(?:{_BLANK}?[(\[]|[)\]]{_BLANK}?|{_BLANK}|[./])"
_BETWEEN = re.compile(rf"{_PART}(?:[A-Z]{{1,4}}{_PART})?")


def emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL_END.match(text, start - 1):
            start -= 1
        end = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            last = end = m.end()
        else:
            last = at + 1
        at = text.find("@", end)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    parts = lambda s: [p.lstrip("0") or "0" for p in s.split(".")]
    return [m.span() for m in _IP.finditer(text) if all(len(p) < 4 and int(p) <= 255 for p in parts(m[0]))]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(int(d) // 5 + int(d) * 2 % 10 for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *s) for s in ips(text)] + [("card", *s) for s in cards(text)]
        found += [("phone", *s) for s in phones(text)] if "+" in text else []
    return found


def _contexts(text: str, start: int, end: int, width: int = 64) -> list[str]:
    """The word before, the two words before and the word after; words of at most `width` characters count."""
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 2 * width) : start])[-2:]]
    after = _WORD.search(text, end, end + width)
    out = [f"{before[-1]} _"] if before else []
    out += [f"{before[0]} {before[1]} _"] if len(before) == 2 else []
    return out + ([f"_ {after[0].lower()}"] if after else [])


def _identifier(groups: list[str]) -> bool:
    return sum(len(g.strip("-_")) for g in groups) >= 6 and sum(len(_DIGIT.findall(g)) for g in groups) >= 2


def _candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, start of its run, end of its run) of the identifier-like tokens and runs that touch no span."""
    taken = sorted((s, e) for _, s, e in spans)
    runs: list[list[tuple[int, int]]] = []
    at, k, joins = 0, 0, False
    while m := _DIGIT.search(text, at):
        start = m.start()
        while start > at and _TOKEN_CHAR.match(text, start - 1):
            start -= 1
        end = _TOKEN.match(text, m.start()).end()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
            joins = False
        if k < len(taken) and taken[k][0] < end:
            joins = False
        else:
            if joins and start - at <= 8 and _BETWEEN.fullmatch(text, at, start):
                runs[-1].append((start, end))
            else:
                runs.append([(start, end)])
            joins = True
        at = end
    out = []
    for run in runs:
        start, end = run[0][0], run[-1][1]
        if len(run) > 1 and _identifier([text[s:e] for s, e in run]):
            for opening, closing in ("()", "[]"):
                if text[start - 1 : start] == opening and text.find(closing, start, end) >= 0:  # (212) 555-0199
                    start -= 1
                    break
            out.append((start, end, start, end))
        out += [(s, e, start, end) for s, e in run if _identifier([text[s:e]])]
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_INSTANCES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("run", pa.int32()), ("run_end", pa.int32()), ("seed", pa.bool_()), ("value", pa.int64()), ("contexts", pa.list_(pa.string()))]))
_BASE = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
    "instances array<struct<start:int;end:int;run:int;run_end:int;seed:boolean;value:bigint;contexts:array<string>>>"
)


def _base_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def make():
        resident(None, None)
        def value(text, start, end):
            return xxhash.xxh64_intdigest(text[start:end].lower().encode("utf-8", "replace")) - (1 << 63)

        def step(texts: pa.Array):
            columns: list[list] = [[] for _ in range(7)]
            for t in as_texts(texts):
                spans = base_spans(t)
                loose = _candidates(t, spans)
                for i, kind in enumerate(KINDS):
                    columns[i].append(sum(s[0] == kind for s in spans))
                columns[4].append(hashlib.sha256(joined(spans).encode()).hexdigest())
                columns[5].append(joined(spans))
                places = [(s, e, s, e, True) for _, s, e in spans] + [(*place, False) for place in loose]
                columns[6].append([
                    {"start": s, "end": e, "run": r, "run_end": q, "seed": seed, "value": value(t, s, e), "contexts": _contexts(t, s, e)} for s, e, r, q, seed in places
                ])
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [_INSTANCES]
            return [pa.array(c, k) for c, k in zip(columns, kinds)]

        return step

    keys = {"doc_id": doc_id, "row": F.monotonically_increasing_id()}
    return map_texts(docs, keys, text, make, _BASE.replace(";", ","))


def score_graph(edges: DataFrame, *, rounds: int, damping: float, least: int) -> tuple[DataFrame, DataFrame]:
    """(context, score) and (value, confidence) of a graph (context, value, seed) after `rounds` rounds.

    score(context) = sum of its instances' confidence / (their number + damping), 0 below `least` distinct
    instances; confidence(instance) = its best context's score, 1 for a seed.
    """
    known = settle(edges.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("confidence")), "confidence")
    scores = None
    for _ in range(rounds):
        held = edges.select("context", "value").join(known, "value")
        scores = held.groupBy("context").agg(F.count(F.lit(1)).alias("n"), F.sum("confidence").alias("total"))
        scores = settle(scores.select("context", F.when(F.col("n") >= least, F.col("total") / (F.col("n") + damping)).otherwise(0.0).alias("score")), "scores")
        best = edges.join(scores, "context").groupBy("value").agg(F.max("score").alias("score"), F.max("seed").alias("seed"))
        known = settle(best.select("value", F.when(F.col("seed"), 1.0).otherwise(F.col("score")).alias("confidence")), "confidence")
    return scores, known


def personal_data(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rounds: int = 3, damping: float = 0.5, least: int = 5, accept: float = 0.85
) -> DataFrame:
    """Personal data in every whole text, one row per row of `docs`, repeated rows too.

    doc_id (null stays null); n_email, n_ip, n_card, n_phone: spans of the patterns; base_sha256: of those spans
    written kind:start:end (code points, end exclusive) by kind and start, joined by commas; spans: the same
    text with the spans of kind `other` that contexts revealed after them; n_other. A context of `least` distinct
    seeds and nothing else is trusted (5 / 5.5 is above `accept`), and still is when it reveals a first identifier; in
    larger ones the share of seeds decides, and damping hardly counts. A null or empty text has no
    spans and the hash of the empty text. An empty table gives no rows.
    """
    base = settle(_base_rows(docs, doc_id, text), "base_spans")
    found = base.select("row", F.explode("instances").alias("i")).select("row", "i.*")
    edges = found.select("value", "seed", F.explode("contexts").alias("context"))
    edges = settle(edges.groupBy("context", "value").agg(F.max("seed").alias("seed")), "edges")
    scores, known = score_graph(edges, rounds=rounds, damping=damping, least=least)
    sure = known.filter(F.col("confidence") >= accept).select("value")
    trusted = scores.filter(F.col("score") >= accept).select("context")
    place = ["row", "run", "run_end", "start", "end"]
    loose = found.filter("NOT seed").join(sure, "value", "left_semi").select(*place, F.explode("contexts").alias("context"))
    accepted = loose.join(trusted, "context", "left_semi").select(*place).distinct()
    whole = F.max((F.col("start") == F.col("run")) & (F.col("end") == F.col("run_end")))  # the run, in place of its tokens
    per_run = accepted.groupBy("row", "run", "run_end").agg(
        F.when(whole, F.array(F.struct(F.col("run").alias("start"), F.col("run_end").alias("end")))).otherwise(F.collect_list(F.struct("start", "end"))).alias("s")
    )
    per_row = per_run.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("s"))).alias("s")).select(
        "row", F.size("s").cast("long").alias("n_other"),
        F.array_join(F.transform("s", lambda x: F.format_string(f"{FOUND}:%d:%d", x["start"], x["end"])), ",").alias("others"),
    )
    out = base.drop("instances").join(per_row, "row", "left")
    both = F.when(F.col("others").isNull(), F.col("base")).when(F.col("base") == "", F.col("others")).otherwise(F.concat_ws(",", "base", "others"))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", both.alias("spans"), F.coalesce("n_other", F.lit(0)).cast("long").alias("n_other"))
