"""The repair against all rows of edits, and the spread-out form against one conversation at a time."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from emberlink.llm import dialogue as dl
from emberlink.llm.glr import Grammar, Repairer

RIGHT = re.compile("(s?(ua)+)?")
KINDS = st.lists(st.tuples(st.sampled_from(["s", "u", "a", ""]), st.booleans(), st.booleans()), max_size=4)


def _repair(kinds):
    r = Repairer()
    front, cost, trail = r.run(r.front(r.root), kinds)
    state, more, behind = r.finish(front)
    way = r.trace(trail, state)
    return cost + more, "".join(b.edits for b in way) + "I" * len(behind), "".join(b.symbols for b in way) + behind


def _all_edits(kinds, most=2):
    """Every choice of up to ``most`` insertions at each place, and an edit for each row."""
    best = None
    inserts = ["".join(p) for n in range(most + 1) for p in itertools.product("ua", repeat=n)]
    choices = []
    for own, must_go, flawed in kinds:
        row = [(4, "D", "")]
        if not must_go:
            row += [(3 * (t != own) + 3 * flawed, "K" if t == own else "R", t) for t in {own or "u", "u", "a"}]
        choices.append([(c + 3 * len(i), "I" * len(i) + e, i + t) for i in inserts for c, e, t in row])
    choices.append([(3 * len(i), "I" * len(i), i) for i in inserts])
    for way in itertools.product(*choices):
        symbols = "".join(w[2] for w in way)
        if RIGHT.fullmatch(symbols):
            found = (sum(w[0] for w in way), "".join(w[1] for w in way), symbols)
            best = found if best is None else min(best, found)
    return best


@settings(max_examples=60, deadline=None)
@given(KINDS.filter(lambda k: len(k) <= 3))
def test_against_all_edits(kinds):
    assert _repair(kinds) == _all_edits(kinds)


def _table(kinds):
    """The same by states of the regular language, carrying whole audits."""
    heads = {"0": (0, "", "")}
    step = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "T", ("T", "u"): "U"}
    for own, must_go, flawed in kinds:
        found = defaultdict(list)
        for state, (cost, audit, symbols) in heads.items():
            found[state].append((cost + 4, audit + "D", symbols))
            for made in ["", "u", "a", "ua", "au"] if not must_go else []:
                for t in {own, "u", "a"} - {""}:
                    at = state
                    for x in made + t:
                        at = step.get((at, x))
                    if at:
                        found[at].append((cost + 3 * len(made) + 3 * (t != own) + 3 * flawed, audit + "I" * len(made) + ("K" if t == own else "R"), symbols + made + t))
        heads = {s: min(f) for s, f in found.items()}
    ends = {"0": "", "T": "", "U": "a", "S": "ua"}
    return min((c + 3 * len(ends[s]), a + "I" * len(ends[s]), y + ends[s]) for s, (c, a, y) in heads.items())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", ""]), st.booleans(), st.booleans()), max_size=40))
def test_against_a_table_of_states(kinds):
    assert _repair(kinds) == _table(kinds)


def test_another_grammar():
    """Brackets, whose stacks need reductions of their own."""
    nested = Grammar((("S", ()), ("S", ("L",)), ("L", ("x", "y")), ("L", ("L", "x", "y"))), "xy")
    r = Repairer(nested, slack=None)
    front, cost, trail = r.run(r.front(r.root), [("x", False, False), ("x", False, False), ("y", False, False)])
    state, more, behind = r.finish(front)
    assert (cost + more, "".join(b.edits for b in r.trace(trail, state)) + "I" * len(behind)) == (3, "KIKK")


def test_fronts_are_few():
    rng, r = random.Random(4), Repairer()
    kinds = [(rng.choice(["s", "u", "a", ""]), rng.random() < 0.2, rng.random() < 0.2) for _ in range(20_000)]
    r.run(r.front(r.root), kinds)
    assert len(r._steps) < 500 and len(r.nodes) <= 12


# ---- whole tables ---------------------------------------------------------------------------


def _brute(rows):
    """rows: (conv_id, turn, role, text), no two with one turn unless they are equal."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, kinds, faults = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in got:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            kinds.append((role[:1] if role[:1] in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {r[0] for r in got} - {None}
        cost, audit, symbols = _table(kinds)
        made, at, lines = iter(symbols), 0, []
        for edit in audit:
            name = {"s": "system", "u": "user", "a": "assistant"}[next(made)] if edit != "D" else None
            if edit != "I":
                _, role, text = got[at]
                at += 1
                name = role if edit == "K" else name
            if edit != "D":
                lines.append(f"{name}:{'' if edit == 'I' else text}")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _conversations():
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn, "system" if turn == 0 and conv % 2 else role, rng.choice(["Yes.", "No!", "why", " ", "", "Same text.", f"t{rng.random()}?"])))
    # One conversation holds more than a third of all rows, most of them alike.
    rows += [(-7, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Hot.", "Hot.", f"row {t}.", "cut"])) for t in range(-200, 300)]
    rows += [(1000, 2**60, "user", "Large number."), (1000, None, "system", "No turn."), (1000, -(2**60), "assistant", "A.\x0b \x85"), (1001, None, None, None)]
    rows += [(None, 1, "user", "Nobody?"), (None, 2, "assistant", "x" * 100_000 + "."), (None, 3, None, "日本."), (None, 4, "", "Empty role."), (1002, 1, "user", "Twice."), (1002, 1, "user", "Twice.")]
    rows += [(c, t, "user", "Hm.") for c in range(2000, 2040) for t in range(2)]
    return rows


@pytest.mark.parametrize("bytes_", [dl.TASK_BYTES, 3000])
def test_against_one_at_a_time(spark, tmp_path, monkeypatch, bytes_):
    """Also in so many ranges that the large conversation lies in dozens of them."""
    monkeypatch.setattr(dl, "TASK_BYTES", bytes_)
    rows, want = _conversations(), _brute(_conversations())
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "'x' AS conv", "true AS gone")
    frame.repartition(5).write.parquet(str(tmp_path / "conversations.parquet"))
    got = dl.op13_conversation_repair(spark, str(tmp_path)).collect()
    assert len(got) == len(want)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want
    if bytes_ < 10_000:
        damaged = dl.damage(frame)
        found = dl.repair(damaged)
        assert found.pieces.where("conv_id = -7").count() > 8


def test_equal_rows_spread(spark):
    """One row, thousands of times: all but the first are duplicates, wherever they lie."""
    rows = spark.range(3000).select(F.lit(5).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
    found = dl.repair(dl.as_rows(rows))
    counts = found.split.collect()[0]
    assert (counts["duplicate"], counts["illegal"], counts["gaps"], counts["cost"]) == (2999, 2999, 0, 4 * 2999 + 3)
    turns = [(t["role"], t["text"]) for p in found.pieces.orderBy("part").collect() for t in p["turns"]]
    assert turns == [("user", "Hi."), ("assistant", "")]


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dl.digests(dl.repair(dl.damage(none))).collect() == []
