"""Conversation repair against plain Python: every sequence of edits for short conversations, a plain table of costs for long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from filingloom.llm import turns as module
from filingloom.llm.grammar import TERMINALS, Grammar, finish, learn, written
from filingloom.llm.common import Stage
from filingloom.llm.turns import damaged, op12_repair_turns, repair_conversations, turn_digests

PATTERN = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    """Rows (turn, role, text) in order: the first fault of each."""
    seen, out = set(), []
    for _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def outcome(rows, faults, audit):
    """Cost and repaired rows of an audit, or None if it breaks a rule."""
    cost, at, out = 0, 0, []
    for e in audit:
        want = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if e == "I":
            cost += 5
            out.append((want, ""))
            continue
        _, role, text = rows[at]
        if e == "D":
            cost += 2
        else:
            if faults[at] in ("blank", "duplicate"):
                return None
            cost += (e == "R") + 5 * (faults[at] == "truncated")
            out.append((role if e == "K" else want, text))
        at += 1
    return (cost, out) if PATTERN.fullmatch("".join(r[:1] or "-" for r, _ in out)) else None


def cheapest(rows, faults):
    """By trying all edits, with up to two turns inserted at each place."""
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(faults, letters, strict=True)):
            continue
        for inserted in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * n + e for n, e in zip(inserted, (*letters, ""), strict=True))
            done = outcome(rows, faults, audit)
            if done and (best is None or (done[0], audit) < best[:2]):
                best = (done[0], audit, done[1])
    return best


def table(rows, faults):
    """By a table of the best edits up to each row, for each last initial."""
    def grown(state):
        out = dict(state)
        for _ in range(2):
            for last, (cost, audit) in list(out.items()):
                to = "a" if last == "u" else "u"
                option = (cost + 5, audit + "I")
                if to not in out or option < out[to]:
                    out[to] = option
        return out

    state = {"": (0, "")}
    for (_, role, _), fault in zip(rows, faults, strict=True):
        new = {}
        for last, (cost, audit) in grown(state).items():
            options = [(last, cost + 2, "D")]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                to = "a" if last == "u" else "u"
                options.append((to, cost + 1 + more, "R"))
                if role[:1] == to or (role[:1] == "s" and last == ""):
                    options.append((role[:1], cost + more, "K"))
            for to, c, e in options:
                if to not in new or (c, audit + e) < new[to]:
                    new[to] = (c, audit + e)
        state = new
    cost, audit = min(v for k, v in grown(state).items() if k in ("", "a"))
    return cost, audit, outcome(rows, faults, audit)[1]


def expected(rows, solve):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults = faults_of(rows)
    cost, audit, repaired = solve(rows, faults)
    known = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    lines = "\n".join(f"{r}:{t}" for r, t in repaired)
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def found(spark, rows, **more):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    report, turns = repair_conversations(frame, **more)
    hashes = {}
    for r in turn_digests(turns).collect():
        assert r.conv not in hashes
        hashes[r.conv] = r.digest
    return {r.conv_id: (*r[1:], hashes[r.conv_id]) for r in report.collect()}


def made(rng, n, length):
    out = []
    for c in range(n):
        for t in range(rng.randrange(1, length + 1)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "User"])
            text = rng.choice(["Yes.", "No!", "half a", "", " \t", f"text {rng.randrange(9)}.", f"cut {rng.randrange(4)}", "end. \n", " "])
            out.append((c, None if rng.random() < 0.1 else t + (t > 2) * rng.randrange(2), role, text))
    return out


def by_conv(rows):
    out = {}
    for c, *r in rows:
        out.setdefault(c, []).append(tuple(r))
    return out


def test_short_conversations_against_all_edits(spark):
    rows = made(random.Random(5), 250, 4)
    got = found(spark, rows)
    assert got == {c: expected(r, cheapest) for c, r in by_conv(rows).items()}
    assert len({v[6] for v in got.values()}) > 30


@pytest.mark.parametrize(("stretch", "fan"), [(None, 64), (3, 2), (1, 3)])
def test_long_conversations_in_any_stretches(spark, stretch, fan):
    rng = random.Random(6)
    rows = made(rng, 20, 40) + [(100, t, rng.choice(["user", "assistant"]), f"line {t}.") for t in range(120)] + [(101, t // 3, "user", "same.") for t in range(90)]
    rows += [(102, None, "assistant", "x"), (102, None, "user", "x."), (103, 5, "user", "   ")]
    assert found(spark, rows, stretch=stretch, fan=fan) == {c: expected(r, table) for c, r in by_conv(rows).items()}


def test_edges(spark):
    long = "word " * 400_000 + "."
    rows = [(1, 0, "user", long), (1, 1, "assistant", "ok."), (None, 3, "user", "a."), (None, None, None, "b."), (2, 2**62, "user", None), (2, -(2**62), None, None)]
    got = found(spark, rows)
    assert got[1][:7] == (0, 0, 0, 0, 0, 0, "KK")
    given = by_conv([(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows])
    assert got == {c: expected(r, cheapest) for c, r in given.items()}
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = frame.selectExpr("*", "1 AS at", "'x' AS n", "2 AS copy", "3 AS pos", "4 AS Symbols")
    report, turns = repair_conversations(clash)
    assert report.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    assert {r.conv_id: tuple(r[1:]) for r in report.collect()} == {c: v[:7] for c, v in got.items()}
    report, turns = repair_conversations(frame.limit(0))
    assert report.count() == 0 and turns.count() == 0 and turn_digests(turns).count() == 0
    repeated = found(spark, rows + rows[1:2])
    assert repeated[1][2] == 1 and repeated[1][6] == "KKD"


def test_grammar_is_shared_and_changes_nothing(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("uaUAsod") for _ in range(rng.randrange(1, 40))) for _ in range(300)] + ["ua" * 200, "d" * 333]
    grammar = learn(spark.createDataFrame([(t,) for t in texts], "symbols string").repartition(3), Stage(spark))
    assert len(grammar.rules) > 20 and len(grammar.compressed("ua" * 200)) < 40
    plain = Grammar([])
    for t in texts:
        a, b = grammar.evaluate(t), plain.evaluate(t)
        assert [x and (x[0], written(x[1])) for x in a] == [x and (x[0], written(x[1])) for x in b]
        stop, added, cost = finish([x and (x[0], written(x[1])) for x in a[:4]])
        assert stop in (0, 2, 3, 1) and cost >= 0 and added >= 0
    assert learn(spark.createDataFrame([], "symbols string"), Stage(spark)).rules == []
    assert set("".join(texts)) <= set(TERMINALS)


def test_registered_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    kept, ids = {}, {r[0] for r in rows}
    for c, t, role, text in rows:
        hit = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        kept.setdefault(c, []).extend([(t, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1))
    got = {r.conv_id: tuple(r[1:]) for r in op12_repair_turns(spark, sf_dir).collect()}
    assert got == {c: expected(kept[c], table) for c in ids}


def test_everything_dropped(spark):
    frame = spark.createDataFrame([(1, 1, "user", "a."), (2, 1, "user", "a.")], "conv_id long, turn long, role string, text string")
    report, turns = repair_conversations(frame, F.col("conv_id") == 1)
    got = {r.conv_id: tuple(r[1:]) for r in report.collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "")
    assert {r.conv: r.digest for r in turn_digests(turns).collect()}[1] == hashlib.sha256(b"").hexdigest()
    odd = spark.createDataFrame([(None, None, None, None)], "conv_id long, turn long, role string, text string")
    out, dropped, copies = damaged(odd)
    hit = zlib.crc32(b" : ") % 20
    assert out.select("_hit").first()[0] == hit and module.LEGAL == ("su", "ua", "au")
