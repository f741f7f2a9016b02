import hashlib
import random
import zlib

import numpy as np
import pytest

from threadloom.llm import repair

WHITE = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
NEED = {"": "user", "s": "user", "a": "user", "u": "assistant"}


def hurt(rows):
    """Rows after damage by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if way == 1 else text.translate(str.maketrans("", "", ".!?")) if way == 2 else text
        role = "user" if way == 4 else role
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(way, 1)
    return {c: sorted(k, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest())) for c, k in out.items()}


def closed(best):
    """Best (cost, audit, lines) by state with up to two inserts more."""
    for _ in range(2):
        for state, (cost, audit, lines) in list(best.items()):
            role = NEED[state]
            new = cost + 3, audit + "I", [*lines, role + ":"]
            best[role[0]] = min(best.get(role[0], new), new)
    return best


def brute(rows):
    turns = sorted({t for t, _, _ in rows if t is not None})
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    seen, best = set(), {"": (0, "", [])}
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        new = {}
        for state, (cost, audit, lines) in closed(best).items():
            ways = [(state, "D", 4, [])]
            if fault in ("", "truncated"):
                more = 3 * (fault != "")
                ways.append((NEED[state][0], "R", 3 + more, [f"{NEED[state]}:{text}"]))
                if (state, role[:1]) in NEXT:
                    ways.append((role[:1], "K", more, [f"{role}:{text}"]))
            for to, label, price, line in ways:
                way = cost + price, audit + label, lines + line
                new[to] = min(new.get(to, way), way)
        best = new
    cost, audit, lines = min(v for k, v in closed(best).items() if k in ("", "a"))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
    return (gaps, *counts.values(), illegal, cost, audit), lines


def some_rows():
    rng = random.Random(8)
    texts = ["yes.", "no!", "well", " \t", "", None, "is it?", "fine. \n", "half"]
    rows = [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (-3, None, None, None), (-3, None, "user", "x."), (-3, 4, "", "y."), (-3, 4, "tool", "y.")]
    for conv in range(150):
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), rng.choice(texts) if rng.random() < 0.3 else f"text {rng.random()}" + rng.choice(["", ".", "."])))
    rows += [(1000, turn, ["user", "assistant"][turn % 2] if rng.random() < 0.8 else "system", f"long {turn}" + rng.choice(["", ".", ".", ". "])) for turn in range(1300)]
    rows += [(1001, 5, "user", "same.")] * 700
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    rows = some_rows()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as key", "2 as mark", "3 as kind", "4 as piece", "5 as code")
    return rows, frame.repartition(3)


@pytest.mark.parametrize("piece", [3, 512])
def test_report_equals_brute_force(talks, monkeypatch, piece):
    rows, frame = talks
    monkeypatch.setattr(repair, "PIECE", piece)
    monkeypatch.setattr(repair, "GRAPH_NODES", 3000)
    want = {}
    for conv, kept in hurt(rows).items():
        found, lines = brute(kept)
        want[conv] = (*found, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    got = {r.conv_id: tuple(r[n] for n in (*repair.REPORT, "audit", "repaired_sha256")) for r in repair.report(repair.damaged(frame)).collect()}
    assert got.keys() == want.keys()
    assert {k: v for k, v in got.items() if v != want[k]} == {}


def test_repaired_rows_follow_the_grammar(talks):
    rows, frame = talks
    talk = {}
    for r in repair.repaired(repair.damaged(frame)).collect():
        talk.setdefault(r.conv_id, []).append((r.place, r.edit, r.role, r.text))
    for conv, kept in hurt(rows).items():
        own = sorted(talk.get(conv, []))
        assert [p for p, *_ in own] == list(range(len(own)))
        assert [f"{role}:{text}" for _, _, role, text in own] == brute(kept)[1]


def test_ranks_break_ties_by_the_rest_of_the_audit():
    """Random pieces between random costs: edits are the least of all cheapest audits, from every state."""
    rng = np.random.default_rng(3)
    pieces = [bytes(rng.integers(0, 4, n).astype(np.uint8) + 4 * rng.choice([0, 0, 1, 3], n).astype(np.uint8)) for n in rng.integers(1, 9, 60)]
    beyond = rng.integers(0, 12, (60, 4))
    names, faults = ["", "s", "u", "a"], {0: "", 4: "blank", 8: "duplicate", 12: "truncated"}
    for codes, costs, found in zip(pieces, beyond, repair.solve(pieces, beyond, (0, 1, 2, 3))):
        for entry in range(4):
            best = {names[entry]: (0, "")}
            for code in codes:
                new = {}
                for state, (cost, audit, _) in closed({k: (*v, []) for k, v in best.items()}).items():
                    ways, fault, initial = [(state, "D", 4)], faults[code & 12], names[code & 3]
                    if fault in ("", "truncated"):
                        more = 3 * (fault != "")
                        ways.append((NEED[state][0], "R", 3 + more))
                        if (state, initial) in NEXT:
                            ways.append((initial, "K", more))
                    for to, label, price in ways:
                        new[to] = min(new.get(to, (cost + price, audit + label)), (cost + price, audit + label))
                best = new
            total, audit, state = min((c + costs[names.index(k)], a, names.index(k)) for k, (c, a) in best.items())
            assert found[entry] == (audit.encode(), state, total - costs[state])


def test_no_rows(talks):
    assert repair.report(repair.damaged(talks[1].where("false"))).count() == 0
