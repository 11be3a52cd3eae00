"""Conversation repair against trying every list of edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.conftest import SF
from unilake.llm import conversations as cv
from unilake.llm import queries

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
FORM = re.compile("(s?(ua)+)?")


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        chars = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not chars else "duplicate" if (role, text) in seen else
                   "fine" if chars[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_edits(rows, kinds):
    """Least (cost, audit, lines) by a table of strings over the initials so far."""
    def put(table, initials, item):
        if initials not in table or item < table[initials]:
            table[initials] = item

    def shape(s):  # what matters of the initials: nothing, s, open or whole
        return "" if s == "" else "s" if s == "s" else "u" if s[-1] == "u" else "a"

    def grown(s, c):
        full = {"": "", "s": "s", "u": "u", "a": "ua"}[s] + c
        return shape(full) if re.fullmatch("s?(ua)*u?", full) and c else None

    def widen(table):
        out = dict(table)
        for _ in range(2):
            for s, (cost, audit, lines) in list(out.items()):
                for role in ("user", "assistant"):
                    to = grown(s, role[0])
                    if to is not None:
                        put(out, to, (cost + 3, audit + "I", lines + (f"{role}:",)))
        return out

    table = {"": (0, "", ())}
    for (_, _, role, text), kind in zip(rows, kinds, strict=True):
        new = {}
        for s, (cost, audit, lines) in widen(table).items():
            put(new, s, (cost + 4, audit + "D", lines))
            if kind in ("blank", "duplicate"):
                continue
            more = 3 * (kind == "truncated")
            to = grown(s, role[:1])
            if to is not None:
                put(new, to, (cost + more, audit + "K", lines + (f"{role}:{text}",)))
            for other in ("user", "assistant"):
                to = grown(s, other[0])
                if to is not None:
                    put(new, to, (cost + 3 + more, audit + "R", lines + (f"{other}:{text}",)))
        table = new
    last = widen(table)
    return min(last[s] for s in ("", "a") if s in last)


def every_edit(rows, kinds):
    """Least (cost, audit, lines) of all lists of edits, spelled out."""
    best = None
    fill = [()] + [(r,) for r in ("user", "assistant")] + list(itertools.product(("user", "assistant"), repeat=2))
    for gaps in itertools.product(fill, repeat=len(rows) + 1):
        for how in itertools.product("DKua", repeat=len(rows)):
            cost, audit, lines = 0, "", []
            for i, gap in enumerate(gaps):
                cost, audit = cost + 3 * len(gap), audit + "I" * len(gap)
                lines += [(g, "") for g in gap]
                if i == len(rows):
                    break
                role, text = rows[i][2:]
                if how[i] == "D":
                    cost, audit = cost + 4, audit + "D"
                    continue
                if kinds[i] in ("blank", "duplicate"):
                    cost = 10**9
                cost += 3 * (kinds[i] == "truncated") + 3 * (how[i] != "K")
                audit += "K" if how[i] == "K" else "R"
                lines.append((role if how[i] == "K" else {"u": "user", "a": "assistant"}[how[i]], text))
            if FORM.fullmatch("".join(r[:1] or "-" for r, _ in lines)):
                item = (cost, audit, tuple(f"{r}:{t}" for r, t in lines))
                best = item if best is None or item < best else best
    return best


def truth(original, rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = []
    for c in {r[0] for r in original}:
        own = in_order(by[c])
        kinds = faults(own)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(own)]
        cost, audit, lines = plain_edits(own, kinds)
        out.append((c, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return Counter(out)


def feed(rows, kinds):
    a = cv.Audit()
    for (_, _, role, _), kind in zip(rows, kinds, strict=True):
        a.turn(role[:1], ["fine", "blank", "duplicate", "truncated"].index(kind))
    return a.finish()


def test_every_list_of_edits():
    rng = random.Random(2)
    for _ in range(25):
        rows = [(0, i, rng.choice(["user", "assistant", "system", "", "tool"]), f"t{i}.") for i in range(rng.randint(0, 3))]
        kinds = [rng.choice(["fine", "fine", "blank", "truncated"]) for _ in rows]
        want = every_edit(rows, kinds)
        assert plain_edits(rows, kinds) == want and feed(rows, kinds) == want[:2]


@pytest.mark.parametrize("step", [1, 2, 5, 32])
def test_letters_set_aside(monkeypatch, step):
    monkeypatch.setattr(cv, "STEP", step)
    monkeypatch.setattr(cv, "DIGITS", 3 + 3 * step)
    rng = random.Random(step)
    for n in [0, 1, 3, 7, 20, 33, 64, 65, 150] * 4:
        odd = rng.random()
        rows = [(0, i, ("user", "assistant")[i % 2] if rng.random() > odd else
                 rng.choice(["user", "assistant", "system", "x"]), "t.") for i in range(n)]
        kinds = [rng.choice(["fine"] * 5 + ["blank", "duplicate", "truncated"]) for _ in rows]
        assert feed(rows, kinds) == plain_edits(rows, kinds)[:2]


def test_long_conversation_stays_small():
    a = cv.Audit()
    for i in range(20_000):
        a.turn("ua"[i % 2], cv.FINE)
    assert max(s[0].bit_length() for s in a.states if s) < 400
    assert a.finish() == (0, "K" * 20_000)


def odd_rows():
    rng = random.Random(8)
    rows = [(None, 1, "user", "Hi."), (None, 2, None, "x"), (None, None, "assistant", None), (1, None, None, None),
            (2, 5, "user", " \t\n\x0b\r "), (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 9, "assistant", "é" * 30000),
            (3, 1, "system", "S."), (3, 2, "user", "a\nb:c."), (3, 3, "assistant", "no end"), (4, 0, "", "no role."),
            (5, 1, "Übel", "x."), (5, 1 << 62, "user", "far."), (6, -3, "user", "neg."), (6, 0, "assistant", "z. \x85")]
    for c in range(10, 120):
        for t in range(rng.choice([1, 2, 3, 5, 8, 40 if c % 9 == 0 else 4])):
            rows.append((c, t * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "user", "assistant", "system", None]),
                         rng.choice(["Yes.", "no", "", "What? ", "a. b", "Fine!"])))
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("sha", "seen", "fault", "audit", "copy", "conv"):
        df = df.withColumn(c, F.lit("x"))
    got = cv.repair_report(cv.damaged(df), df)
    assert Counter(tuple(r) for r in got.collect()) == truth(rows, damage(rows))
    empty = spark.createDataFrame([], SCHEMA)
    assert cv.repair_report(cv.damaged(empty), empty).collect() == []


def test_repaired_turns(spark):
    """The turns themselves are well formed and as cheap as the report says."""
    rows = [(r[0], r[1], r[2] or "", r[3] or "") for r in odd_rows()]
    df = spark.createDataFrame(rows, SCHEMA)
    found = cv.reports(df)
    by = defaultdict(list)
    for r in cv.repaired(df, found).collect():
        by[r["conv_id"]].append(r)
    for r in found.collect():
        turns = sorted(by[r["conv_id"]], key=lambda x: x["seq"])
        assert [t["seq"] for t in turns] == list(range(len(turns)))
        assert FORM.fullmatch("".join(t["role"][:1] or "-" for t in turns))
        assert "".join(t["edit"] for t in turns) == r["audit"].replace("D", "")
        assert all(t["text"] == "" and t["role"] in ("user", "assistant") for t in turns if t["edit"] == "I")


def test_query(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == truth(rows, damage(rows))
