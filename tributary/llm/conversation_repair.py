"""Repair of the turn structure of conversations by lightest derivations (operator 13).

A conversation's rows, ordered by turn (nulls first), have at most one fault each: ``blank`` (no
character that is not white space), ``duplicate`` (role and text of an earlier row), ``truncated``
(the last such character is not ``.``, ``!`` or ``?``). Edits make the role initials match
``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (1), Delete (2, the only edit of a blank or
duplicate row), Insert an empty user or assistant row (5); a truncated row that stays adds 5. The
cheapest edits win, of these the ones whose initials in order, the audit, are least in ASCII.

The search is a weighted deduction. An item says which state of the pattern is reached after how
many rows; a hyperedge joins the item of a prefix with the item of what follows (an edit, or a span
of rows) and weighs (cost, audit): costs add up, audits are concatenated. This function is superior
(no conclusion is lighter than its prefix) and monotone, so Knuth's agenda can pop items lightest
first, each final when it is popped, until the goal is. Two audits of one item and one cost are
never prefixes of each other, as an insertion costs something.

Long conversations are split: rows are range partitioned by conversation and turn, and each task
cuts its runs into spans of ``SPAN`` rows. A span that may not be the first of its conversation
gets the lightest derivation from every state to every state. Then spans are joined in order, which
holds four prefixes and two bytes a span; the states at the cuts tell each span its edits. The
digest of the repaired rows is read in one pass per conversation in bounded memory, as SHA-256
can't be computed in parts; all other work on a conversation is spread.

Null ids, of conversations or turns, and null roles and texts: a null conversation is one of its
own, null turns come first, a null role or text is one space. Rows of equal turn are ordered by
role and then by the MD5 digest of their text. An empty or other initial can't be kept, but be
reroled. Repeated rows are duplicates. Empty tables give empty results; columns beside the four
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, stored, table

SPAN = 256
#: Rows of a conversation that is remembered as a pattern in each worker.
SHORT = 32
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
ENDS = (START, ASSISTANT)
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
DELETE, RELABEL, INSERT, UNFINISHED = 2, 1, 5, 5
ROLES = {"u": "user", "a": "assistant"}
FAULTS = ("", "blank", "duplicate", "truncated")
Weight = tuple[int, str]
Rule = tuple[int, int, int, str]  # rows taken, state reached, cost, audit


# ---- deduction ----

def lightest(rules: Callable[[int, int], Iterable[Rule]], n: int, axioms: dict[int, Weight],
             goals: Iterable[int] | None = None) -> dict[int, tuple[int, str, int]]:
    """Lightest (cost, audit, first state) of the items of states after ``n`` steps.

    ``axioms`` are the items before the first step, ``rules(place, state)`` what can follow an item.
    With ``goals`` the agenda ends at the first of these that is popped.
    """
    agenda = [(cost, audit, 0, state, state) for state, (cost, audit) in axioms.items()]
    agenda.sort()
    done: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str, int]] = {}
    while agenda:
        cost, audit, place, state, first = heappop(agenda)
        if (place, state) in done:
            continue
        done.add((place, state))
        if place == n:
            found[state] = cost, audit, first
            if goals is not None and state in goals:
                return {state: found[state]}
        for taken, reached, more, letters in rules(place, state):
            if (place + taken, reached) not in done:
                heappush(agenda, (cost + more, audit + letters, place + taken, reached, first))
    return found


def _kind(initial: str, fault: int) -> str:
    """One character for all that the edits of a row depend on."""
    return chr(ord("A") + 3 * "sua-".index(initial) + (0, 1, 1, 2)[fault])


def _edits(kind: str, state: int) -> Iterator[Rule]:
    role, trouble = divmod(ord(kind) - ord("A"), 3)
    yield 1, state, DELETE, "D"
    if trouble == 1:
        return
    more = UNFINISHED * (trouble == 2)
    for initial, reached in FOLLOWS[state].items():
        if initial == "sua-"[role]:
            yield 1, reached, more, "K"
        if initial in ROLES:
            yield 1, reached, RELABEL + more, "R"


def _repairs(kinds: str, start: int, goals: Iterable[int] | None) -> dict[int, tuple[int, str, int]]:
    def rules(place: int, state: int) -> Iterator[Rule]:
        for initial, reached in FOLLOWS[state].items():
            if initial in ROLES:
                yield 0, reached, INSERT, "I"
        if place < len(kinds):
            yield from _edits(kinds[place], state)

    return lightest(rules, len(kinds), {start: (0, "")}, goals)


_short_repairs = lru_cache(maxsize=50_000)(_repairs)


def span_weights(kinds: str, starts: Iterable[int]) -> list[tuple[int, str] | None]:
    """Lightest (cost, audit) from each state to each state, at 4 * from + to."""
    solve = _short_repairs if len(kinds) <= SHORT else _repairs
    out: list[tuple[int, str] | None] = [None] * 16
    for start in starts:
        for state, (cost, audit, _) in solve(kinds, start, None).items():
            out[4 * start + state] = cost, audit
    return out


def repaired(audit: str, kinds: str, state: int) -> Iterator[tuple[int | None, str | None]]:
    """(row, new role) of the rows that stay: no row for an insertion, no role for a kept one."""
    row = 0
    for letter in audit:
        if letter == "D":
            row += 1
        elif letter == "K":
            state = FOLLOWS[state]["sua-"[(ord(kinds[row]) - ord("A")) // 3]]
            yield row, None
            row += 1
        else:
            initial = next(x for x in FOLLOWS[state] if x in ROLES)
            state = FOLLOWS[state][initial]
            yield (row if letter == "R" else None), ROLES[initial]
            row += letter == "R"


# ---- Spark ----

def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with the damage that a hash of conversation and turn picks.

    Of twenty values 0 drops a row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats
    it and 4 makes it a user's.
    """
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    draw = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    changed = rows.withColumn("__draw", draw).filter("__draw <> 0").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(F.col("__draw") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("__draw") == 1, "").when(F.col("__draw") == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"), "__draw")
    copies = F.when(F.col("__draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return changed.withColumn("__copy", F.explode(copies)).drop("__draw", "__copy")


def with_faults(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows with ``seq``, and (no_conv, conv, turn, role, digest, seq, fault) of them.

    Texts are compared by 128-bit digests.
    """
    text = F.col("text")
    ended = F.regexp_like(text, F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    whole = stored(rows.select(
        "*", F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv"),
        F.md5(text.cast("binary")).alias("digest"), (~F.regexp_like(text, F.lit(NON_SPACE))).alias("blank"),
        (~ended).alias("truncated"), F.monotonically_increasing_id().alias("seq")), "damaged")
    same = ["no_conv", "conv", "role", "digest"]
    place = F.struct(F.col("turn").isNotNull().alias("set"), "turn", "seq")
    slim = whole.drop("text", "conv_id").withColumn("place", place)
    # stored, so that the join below reads plain shuffles, whose hot texts Spark can split
    first = stored(slim.filter("NOT blank").groupBy(*same).agg(F.min("place").alias("first"), F.count("*").alias("n"))
                   .filter("n > 1").drop("n"), "first")
    fault = (F.when(F.col("blank"), 1).when(F.col("place") > F.col("first"), 2).when(F.col("truncated"), 3)
             .otherwise(0).cast("int"))
    return whole, slim.join(first, same, "left").select("no_conv", "conv", "turn", "role", "digest", "seq",
                                                        fault.alias("fault"))


SPANS = ("no_conv boolean, conv long, part int, number long, kinds string, seqs binary, blank long, duplicate long, "
         "truncated long, initials string, illegal long, costs array<long>, audits array<string>")
LEGAL = ("su", "ua", "au")


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def spans(rows: DataFrame, longest: int = SPAN) -> DataFrame:
    """Runs of at most ``longest`` rows of one conversation, ordered by (part, number), and their weights."""

    def row_of(conv: tuple[bool, int], part: int, number: int, own: list[tuple[str, int, int]], starts) -> dict:
        initials = [r if r in ("s", "u", "a") else "-" for r, _, _ in own]
        kinds = "".join(_kind(r, f) for r, (_, f, _) in zip(initials, own))
        weights = span_weights(kinds, starts)
        faults = np.bincount([f for _, f, _ in own], minlength=len(FAULTS)).tolist()
        return {"no_conv": conv[0], "conv": conv[1], "part": part, "number": number, "kinds": kinds,
                "seqs": np.array([s for _, _, s in own], np.int64).tobytes(), **dict(zip(FAULTS[1:], faults[1:])),
                "initials": initials[0] + initials[-1], "illegal": _illegal(initials),
                "costs": [w and w[0] for w in weights], "audits": [w and w[1] for w in weights]}

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, number, at, own, out, starts = TaskContext.get().partitionId(), 0, None, [], [], STATES
        for frame in frames:
            for no_conv, conv, initial, fault, seq in zip(*(frame[c].tolist() for c in (
                    "no_conv", "conv", "initial", "fault", "seq"))):
                new = (no_conv, conv) != at
                if own and (new or len(own) == longest):
                    out.append(row_of(at, part, number, own, starts))
                    # a conversation that begins inside the task's rows begins with the pattern
                    own, number, starts = [], number + 1, (START,) if new else STATES
                    if len(out) == 512:
                        yield pd.DataFrame(out)
                        out = []
                at = no_conv, conv
                own.append((initial, fault, seq))
        if own:
            out.append(row_of(at, part, number, own, starts))
        if out:
            yield pd.DataFrame(out)

    order = ["no_conv", "conv", F.col("turn").asc_nulls_first(), "role", "digest", "seq"]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("no_conv", "conv", F.substring("role", 1, 1).alias("initial"), "fault", "seq")
            .mapInPandas(cut, SPANS))


COUNTS = (*FAULTS[1:], "illegal")
CHOICES = ("no_conv boolean, conv long, part int, number long, state int, reached int, blank long, duplicate long, "
           "truncated long, illegal long, cost long, audit string")


def _by_conversation(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("no_conv", "conv").sortWithinPartitions("no_conv", "conv", *order)


def chosen(parts: DataFrame) -> DataFrame:
    """States before and after each span in the lightest repair; the last span has the conversation's result."""

    class Prefix:
        """The lightest prefixes of one conversation, up to the spans seen."""

        def __init__(self, conv: tuple[bool, int]) -> None:
            self.conv, self.items, self.seen, self.back = conv, {START: (0, "")}, [], []
            self.counts, self.last = dict.fromkeys(COUNTS, 0), ""

        def add(self, row: dict) -> None:
            def rules(place: int, state: int) -> Iterator[Rule]:
                if place == 0:
                    for reached in STATES:
                        if not pd.isna(row["costs"][4 * state + reached]):
                            yield 1, reached, int(row["costs"][4 * state + reached]), row["audits"][4 * state + reached]

            found = lightest(rules, 1, self.items)
            self.items = {state: (cost, audit) for state, (cost, audit, _) in found.items()}
            self.back.append(bytes(found[state][2] if state in found else 0 for state in STATES))
            self.seen.append((row["part"], row["number"]))
            for c in COUNTS:
                self.counts[c] += row[c]
            self.counts["illegal"] += bool(self.last) and self.last + row["initials"][0] not in LEGAL
            self.last = row["initials"][1]

        def end(self) -> Iterator[dict]:
            (state, (cost, audit, _)), = lightest(lambda *_: (), 0, self.items, ENDS).items()
            result = {**self.counts, "cost": cost, "audit": audit}
            for (part, number), back in zip(reversed(self.seen), reversed(self.back)):
                yield {"no_conv": self.conv[0], "conv": self.conv[1], "part": part, "number": number,
                       "state": back[state], "reached": state, **result}
                state, result = back[state], dict.fromkeys(result)

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prefix: Prefix | None = None
        names = [c.split()[0] for c in CHOICES.split(", ")]

        def frames_of(rows: Iterable[dict]) -> Iterator[pd.DataFrame]:
            rows = list(rows)
            for at in range(0, len(rows), 4096):
                yield pd.DataFrame(rows[at:at + 4096], columns=names).astype(
                    {c: "Int64" for c in (*COUNTS, "cost")})

        for frame in frames:
            ended: list[dict] = []
            for row in frame.to_dict("records"):
                conv = row["no_conv"], row["conv"]
                if prefix is None or prefix.conv != conv:
                    if prefix is not None:
                        ended += prefix.end()
                    prefix = Prefix(conv)
                prefix.add(row)
            yield from frames_of(ended)
        if prefix is not None:
            yield from frames_of(prefix.end())

    return _by_conversation(parts.drop("kinds", "seqs"), "part", "number").mapInPandas(fold, CHOICES)


def repaired_rows(parts: DataFrame, choices: DataFrame, whole: DataFrame) -> DataFrame:
    """(no_conv, conv, part, number, place, role, text): the rows of the repaired conversations."""

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["no_conv", "conv", "part", "number", "place", "seq", "new_role"]
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                seqs = np.frombuffer(row["seqs"], np.int64)
                for place, (at, role) in enumerate(repaired(row["edits"], row["kinds"], row["state"])):
                    out.append((*(row[c] for c in names[:4]), place, -1 if at is None else int(seqs[at]), role))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    edits = F.element_at("audits", 4 * F.col("state") + F.col("reached") + 1).alias("edits")
    kept = (parts.join(choices.select("part", "number", "state", "reached"), ["part", "number"])
            .select("no_conv", "conv", "part", "number", "kinds", "seqs", "state", edits)
            .mapInPandas(apply, "no_conv boolean, conv long, part int, number long, place long, seq long, new_role string"))
    old = whole.select("seq", F.col("role").alias("old_role"), "text")
    spread = F.when(F.col("seq") >= 0, F.col("seq")).otherwise(-1 - F.col("number"))  # insertions have no row
    return kept.withColumn("seq", spread).join(old, "seq", "left").select(
        "no_conv", "conv", "part", "number", "place", F.coalesce("new_role", "old_role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))


def digests(rows: DataFrame) -> DataFrame:
    """(no_conv, conv, repaired_sha256): SHA-256 of the newline-joined ``role:text`` of each conversation."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, hashlib.sha256()
        for frame in frames:
            out = []
            for no_conv, conv, role, text in zip(*(frame[c].tolist() for c in ("no_conv", "conv", "role", "text"))):
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                if (no_conv, conv) == at:
                    state.update(b"\n" + line)
                else:
                    if at is not None:
                        out.append((*at, state.hexdigest()))
                    at, state = (no_conv, conv), hashlib.sha256(line)
            if out:
                yield pd.DataFrame(out, columns=["no_conv", "conv", "repaired_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, state.hexdigest())], columns=["no_conv", "conv", "repaired_sha256"])

    return (_by_conversation(rows, "part", "number", "place").select("no_conv", "conv", "role", "text")
            .mapInPandas(read, "no_conv boolean, conv long, repaired_sha256 string"))


def repair(rows: DataFrame, longest: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Per conversation (no_conv, conv, gaps, faults, cost, audit), and the rows of the repaired conversations."""
    whole, judged = with_faults(rows.select("conv_id", "turn", "role", "text"))
    parts = stored(spans(judged, longest), "spans")
    choices = stored(chosen(parts), "choices")
    gaps = whole.groupBy("no_conv", "conv").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    results = choices.filter("audit is not null").select("no_conv", "conv", *COUNTS, "cost", "audit")
    return results.join(gaps, ["no_conv", "conv"]), repaired_rows(parts, choices, whole)


def op13_structure_repair(spark, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation after damage."""
    rows = table(spark, sf_dir, "conversations")
    results, fixed = repair(damaged(rows))
    key = ["no_conv", "conv"]
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv"))
    nothing = hashlib.sha256(b"").hexdigest()
    return every.join(results, key, "left").join(digests(fixed), key, "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
