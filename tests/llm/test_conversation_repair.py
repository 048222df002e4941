"""Operator 12 against every edit sequence of small conversations and a plain dynamic program over whole strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from geoincident.llm import conversation_repair as cr

SF = "/root/testdata/sf0.001"
GOOD = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        case = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        out += [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        shown = BLANK.findall(text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else
                   "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain(rows, found):
    """(cost, audit, repaired) by keeping the best whole string of every state."""
    turn_after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def settle(best):
        for _ in range(5):
            for state, (cost, audit, kept) in list(best.items()):
                new = turn_after[state]
                offer(best, new, cost + 3, audit + "I", (*kept, ({"u": "user", "a": "assistant"}[new], "")))
        return best

    def offer(best, state, cost, audit, kept):
        if state not in best or (cost, audit) < best[state][:2]:
            best[state] = (cost, audit, kept)

    best = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, found, strict=True):
        new = {}
        for state, (cost, audit, kept) in settle(best).items():
            offer(new, state, cost + 4, audit + "D", kept)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            to = role[:1]
            if to == turn_after[state] or (state == "" and to == "s"):
                offer(new, to, cost + more, audit + "K", (*kept, (role, text)))
            to = turn_after[state]
            offer(new, to, cost + 3 + more, audit + "R", (*kept, ({"u": "user", "a": "assistant"}[to], text)))
        best = new
    settle(best)
    return min(best[s] for s in ("", "a") if s in best)


def exhaustive(rows, found):
    """(cost, audit) over every sequence of edits with at most three inserts in a gap."""
    best = None
    fills = ["", "u", "a", "ua", "au", "uau", "aua"]
    options = [[("D", "", 4)] + ([] if f in ("blank", "duplicate") else
                                 [(e, i, c + (3 if f == "truncated" else 0))
                                  for e, i, c in (("K", r[2][:1] or "-", 0), ("R", "u", 3), ("R", "a", 3))])
               for r, f in zip(rows, found, strict=True)]
    for edits in itertools.product(*options):
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            roles = gaps[0] + "".join(e[1] + g for e, g in zip(edits, gaps[1:], strict=True))
            if GOOD.fullmatch(roles):
                cost = sum(e[2] for e in edits) + 3 * sum(map(len, gaps))
                audit = "I" * len(gaps[0]) + "".join(e[0] + "I" * len(g) for e, g in zip(edits, gaps[1:], strict=True))
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def expected(rows, every):
    by = {c: [] for c in every}
    for r in damaged(rows):
        by[r[0]].append(r)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        found = faults(own)
        cost, audit, kept = plain(own, found)
        turns = [r[1] for r in own if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(own)]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"),
                     found.count("duplicate"), found.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs),
                     cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def result(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                           r["repaired_sha256"]) for r in rows}


def solved(rows, found):
    v, out, most = cr.Viterbi(), [], 0
    for (_, turn, role, text), fault in zip(rows, found, strict=True):
        out += v.row(role[:1], (text, turn, role, fault, role), fault in ("blank", "duplicate"), fault == "truncated")
        most = max(most, v.open)
    out += v.end()
    assert v.open == 0 and v.root.refs == 1
    return out, most


def random_rows(rnd, n):
    roles = ["system", "user", "assistant", "tool", "user", "assistant", ""]
    return [(0, i, rnd.choice(roles), rnd.choice(["Yes.", "no", " ", "So?", f"n{i}.", f"m{i}", f"k{i}!"])) for i in range(n)]


def test_against_every_sequence():
    rnd = random.Random(4)
    for n in (0, 1, 1, 2, 2, 2, 3, 3, 3, 3):
        for _ in range(4):
            rows = random_rows(rnd, n)
            found = faults(rows)
            assert plain(rows, found)[:2] == exhaustive(rows, found)


def test_viterbi_against_whole_strings():
    rnd = random.Random(9)
    for _ in range(400):
        rows = random_rows(rnd, rnd.randrange(30))
        found = faults(rows)
        edits, _ = solved(rows, found)
        cost, audit, kept = plain(rows, found)
        assert "".join(e for e, _ in edits) == audit
        assert tuple((w[-1], w[0]) for e, w in edits if e != "D") == kept


def test_what_is_held_stays_bounded():
    rnd = random.Random(2)
    rows = [(0, i, rnd.choice(["user", "assistant", "user", "assistant", "tool"]), f"t{i}.") for i in range(20000)]
    edits, most = solved(rows, [None] * len(rows))
    assert len(edits) >= 20000 and most < 400


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(cr.op12_conversation_repair(spark, SF)) == expected(rows, {r[0] for r in rows})


def test_edge_cases(spark):
    rnd = random.Random(12)
    rows = [(c, rnd.choice([None, 0, 1, 2, 3, 4, 5, 9]), rnd.choice(["user", "assistant", "system", None, "tool", ""]),
             rnd.choice([None, "", " \t\n", "Yes.", "no", "é…", "x" * 5000, "Hm!\r\n", "a.\x0b", "a.\xa0", "Yes."]))
            for c in [None, *range(60)] for _ in range(rnd.randrange(1, 9))]
    rows += rows[:40]  # repeated rows
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows.append((gone, 1, "user", "Dropped."))
    df = spark.createDataFrame([(*r, "z", 5, 1) for r in rows],
                               "conv_id long, turn long, role string, text string, edit string, copies int, mark int")
    got = result(cr.report(cr.repair(*cr.damage(df))))
    want = expected(rows, {r[0] for r in rows})
    assert got == want
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = cr.report(cr.repair(df.limit(0)))
    assert empty.count() == 0 and empty.columns[:2] == ["conv_id", "gaps"]
    whole = cr.repair(spark.createDataFrame([("q", 1, "user", "Hi."), ("q", 2, "assistant", "Ho.")],
                                            "conv_id string, turn int, role string, text string"))
    assert [(r["conv_id"], r["edit"], r["role"], r["text"]) for r in whole.collect()] == [
        ("q", "K", "user", "Hi."), ("q", "K", "assistant", "Ho.")]


@pytest.mark.parametrize("turns", [1, 2, 3])
def test_one_conversation_repeats_one_message(spark, turns):
    rows = [(7, i // turns, "user", "Same.") for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert result(cr.report(cr.repair(*cr.damage(df)))) == expected(rows, {7})
