"""Conversation structure repair: the cheapest edits that give whole exchanges.

A conversation is well formed when its turns' role initials read
``(s?(ua)+)?``.  Edits per turn: keep (0), rerole to user or assistant (3),
delete (4; the only choice for blank and repeated turns); an empty user or
assistant turn may be inserted anywhere (3).  A truncated turn that stays costs
3 more.  Of the cheapest edit lists the one whose audit (initials D, I, K, R in
order) is the least string is taken.

Decision: every path through the graph of (turns read, initials so far) has one
integer weight.  Its high digits are the cost, its low digits the audit's letters
at fixed places, D to R as 1 to 4, with zeros behind the last letter; so the
ordinary minimum of integers decides cost and ties together.  Weights have room
for the letters of ``STEP`` turns: after as many, each state's letters are set
aside and replaced by one digit, their rank among the states.  That is exact, as
paths that end with the same turn's letter are never one the beginning of the
other.  So the numbers stay small however long a conversation is.

Two passes, both over a conversation's turns in order (by turn, nulls first, then
role, then the text's digest), streamed from a sorted shuffle and never gathered:

* ``reports``: faults, cost and audit; only digests and flags move, no texts.
* ``repaired``: the audit, sent ahead of its turns, gives the repaired turns.

A conversation's turns pass through one task per shuffle, as the audit and the
SHA-256 over the repaired turns are built in order; what is held of it is the
audit and a constant.

Cases: nulls in conv_id (a conversation of its own), turn, role or text are
allowed (a null text counts as blank, a null role as no initial); turns with one
number stand in the order above; equal rows are repeats; a conversation whose
turns are all dropped has an empty report; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from unilake.llm.common import cut

KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
LETTERS = "\0DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
FINE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
#: Turns whose letters a weight holds.
STEP = 32
#: Digits of the audit: a rank, and at most two inserts and one letter per turn.
DIGITS = 1 + 3 * STEP + 2
_BITS = 3
#: Initials so far: none, s, ..u, ..ua
START, SYSTEM, USER, WHOLE = range(4)
_WORD = r"[^\x20\x09-\x0D]"


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _step(state: tuple[int, int], cost: int, letter: int) -> tuple[int, int]:
    """A state's weight with one more letter and its cost."""
    weight, used = state
    return weight + (cost << _BITS * DIGITS) + (letter << _BITS * (DIGITS - 1 - used)), used + 1


class Audit:
    """Cheapest edits of one conversation, fed turn by turn.

    ``states``: per state the least (weight, digits used), or None; the first
    digit is the rank of the letters set aside, listed in ``aside`` as chains
    (earlier chain, letters).
    """

    def __init__(self):
        self.states: list = [(1 << _BITS * (DIGITS - 1), 1), None, None, None]
        self.aside: list[tuple | None] = [None]
        self.read = 0

    def _ahead(self) -> list:
        """Each state's least weight after no, one or two inserts."""
        a, one, two = self.states, [None] * 4, [None] * 4
        for state in (a[START], a[SYSTEM], a[WHOLE]):
            if state is not None:
                one[USER] = _least(one[USER], _step(state, INSERT_COST, INSERT))
        if a[USER] is not None:
            one[WHOLE] = _step(a[USER], INSERT_COST, INSERT)
        if one[USER] is not None:
            two[WHOLE] = _step(one[USER], INSERT_COST, INSERT)
        if one[WHOLE] is not None:
            two[USER] = _step(one[WHOLE], INSERT_COST, INSERT)
        return [_least(_least(x, y), z) for x, y, z in zip(a, one, two, strict=True)]

    def turn(self, initial: str, fault: int) -> None:
        nxt: list = [None] * 4
        for source, state in enumerate(self._ahead()):
            if state is None:
                continue
            nxt[source] = _least(nxt[source], _step(state, DELETE_COST, DELETE))
            if fault in (BLANK, DUPLICATE):
                continue
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            to = WHOLE if source == USER else USER
            nxt[to] = _least(nxt[to], _step(state, REROLE_COST + more, REROLE))
            if initial == ("a" if source == USER else "u"):
                nxt[to] = _least(nxt[to], _step(state, KEEP_COST + more, KEEP))
            elif initial == "s" and source == START:
                nxt[SYSTEM] = _least(nxt[SYSTEM], _step(state, KEEP_COST + more, KEEP))
        self.states = nxt
        self.read += 1
        if self.read % STEP == 0:
            self._set_aside()

    def _letters(self, state: tuple[int, int]) -> tuple:
        """The chain that a weight's low digits stand for."""
        weight, used = state
        digits = [(weight >> _BITS * (DIGITS - 1 - k)) & 7 for k in range(used)]
        return self.aside[digits[0] - 1], "".join(LETTERS[d] for d in digits[1:])

    def _set_aside(self) -> None:
        low = (1 << _BITS * DIGITS) - 1
        live = sorted((state[0] & low, i) for i, state in enumerate(self.states) if state is not None)
        chains = [self._letters(self.states[i]) for _, i in live]
        for rank, (letters, i) in enumerate(live, 1):
            self.states[i] = (self.states[i][0] - letters + (rank << _BITS * (DIGITS - 1)), 1)
        self.aside = chains

    def finish(self) -> tuple[int, str]:
        """(cost, audit) of the cheapest edits."""
        now = self._ahead()
        best = min(s for s in (now[START], now[WHOLE]) if s is not None)
        parts, chain = [], self._letters(best)
        while chain is not None:
            chain, text = chain
            parts.append(text)
        return best[0] >> _BITS * DIGITS, "".join(reversed(parts))


class Report:
    """What ``reports`` tells of one conversation."""

    def __init__(self):
        self.audit = Audit()
        self.faults = [0, 0, 0, 0]
        self.illegal = self.numbers = 0
        self.least = self.last = self.initial = None

    def turn(self, number: int | None, initial: str, fault: int) -> None:
        if number is not None:  # numbers ascend
            self.numbers += number != self.last
            self.least = number if self.least is None else self.least
            self.last = number
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        self.faults[fault] += 1
        self.audit.turn(initial, fault)

    def row(self) -> tuple:
        cost, audit = self.audit.finish()
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.numbers
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, cost, audit


def _ordered(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the text's digest, nulls in role and text empty."""
    text = F.coalesce(turns["text"], F.lit(""))
    return turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                        F.coalesce(turns["role"], F.lit("")).alias("role"), text.alias("text"),
                        F.unhex(F.sha2(text, 256)).alias("sha"))


_REPORT = [("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"),
           ("cost", "long"), ("audit", "string")]


def reports(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of
    every conversation."""
    rows = _ordered(turns)
    end = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    seen = F.row_number().over(W.partitionBy("conv_id", "role", "sha").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(end == "", BLANK).when(F.substring(end, -1, 1).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    rows = rows.select("conv_id", "turn", "role", "sha", fault.alias("fault")).withColumn("seen", seen)
    fault = F.when((F.col("fault") != BLANK) & (F.col("seen") > 1), DUPLICATE).otherwise(F.col("fault"))
    rows = rows.select("conv_id", "turn", "role", "sha", "seen", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")) \
        .repartition("conv_id").sortWithinPartitions(
            F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "sha", "seen") \
        .select("conv_id", "turn", "initial", "fault")
    names = ["conv_id", *[n for n, _ in _REPORT]]
    schema = pa.schema([(n, pa.string() if n == "audit" else pa.int64()) for n in names])

    def run(batches):
        now, report, out = None, None, []
        for batch in batches:
            for conv, number, initial, fault in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if report is None or conv != now:
                    if report is not None:
                        out.append((now, *report.row()))
                    now, report = conv, Report()
                report.turn(number, initial, fault)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)
            out = []
        if report is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (now, *report.row()), strict=True))], schema=schema)

    return rows.mapInArrow(run, "conv_id long, " + ", ".join(f"{n} {t}" for n, t in _REPORT))


_TURN = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                   ("text", pa.string())])


def _apply(rows) -> Iterator[tuple]:
    """(conv_id, seq, edit, role, text) of the repaired turns.  ``rows``: (conv_id,
    audit or None, role, text), each conversation's audit before its turns."""
    conv, letters, state, seq = None, iter(""), START, 0

    def written(edit, role, text):
        nonlocal state, seq
        if edit == "K" and role[:1] == "s":
            state = SYSTEM
        else:
            state = WHOLE if state == USER else USER
        seq += 1
        return conv, seq - 1, edit, role, text

    def due():
        return "assistant" if state == USER else "user"

    for key, audit, role, text in rows:
        if audit is not None:
            for _ in letters:  # inserts at the end of the last conversation
                yield written("I", due(), "")
            conv, letters, state, seq = key, iter(audit), START, 0
            continue
        for edit in letters:
            if edit == "I":
                yield written("I", due(), "")
                continue
            if edit != "D":
                yield written(edit, due() if edit == "R" else role, text)
            break
    for _ in letters:
        yield written("I", due(), "")


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns (conv_id, seq, edit, role, text), each conversation's
    in order within a partition; ``found``: the ``reports`` of ``turns``."""
    rows = _ordered(turns).withColumn("audit", F.lit(None).cast("string"))
    heads = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
                         F.lit(None).cast("binary").alias("sha"), "audit")
    rows = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "sha") \
        .select("conv_id", "audit", "role", "text")

    def run(batches):
        def each():
            for batch in batches:
                for k in range(0, batch.num_rows, 256):
                    yield from zip(*[c.to_pylist() for c in batch.slice(k, 256).columns], strict=True)

        out, size = [], 0
        for row in _apply(each()):
            out.append(row)
            size += len(row[4]) + 64
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TURN.types)], schema=_TURN)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TURN.types)], schema=_TURN)

    return rows.mapInArrow(run, "conv_id long, seq long, edit string, role string, text string")


def digests(repaired_turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the lines ``role:text``; the turns as ``repaired``
    gives them."""
    def run(batches):
        now, sha = None, None
        for batch in batches:
            keys, values = [], []
            for conv, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if sha is None or conv != now:
                    if sha is not None:
                        keys.append(now)
                        values.append(sha.hexdigest())
                    now, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.string())],
                                             ["conv_id", "repaired_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([sha.hexdigest()])],
                                             ["conv_id", "repaired_sha256"])

    return repaired_turns.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair_report(turns: DataFrame, every: DataFrame) -> DataFrame:
    """The reports, and digests of the repaired turns, of every conv_id of ``every``
    (zeros, an empty audit and the digest of nothing for one without turns)."""
    found = cut(reports(turns))
    shas = digests(repaired(turns, found)).withColumnRenamed("conv_id", "own")
    found = found.withColumnRenamed("conv_id", "conv")
    ids = every.select(every["conv_id"].cast("long").alias("conv_id")).distinct()
    out = ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left") \
        .join(shas, F.col("conv_id").eqNullSafe(F.col("own")), "left")
    return out.select("conv_id", *[F.coalesce(n, F.lit("" if t == "string" else 0)).alias(n) for n, t in _REPORT],
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by the checksum of ``conv_id:turn`` modulo 20: 0 drops
    the turn, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes its role
    user.  Nulls count as one space."""
    gap = F.lit(" ")
    key = F.concat(F.coalesce(turns["conv_id"].cast("string"), gap), F.lit(":"), F.coalesce(turns["turn"].cast("string"), gap))
    rows = turns.select(turns["conv_id"], turns["turn"], F.coalesce(turns["role"], gap).alias("role"),
                        F.coalesce(turns["text"], gap).alias("text"), (F.crc32(key) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")) \
        .otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                           F.explode(times).alias("copy")).drop("copy")
