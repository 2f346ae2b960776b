import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from bourse.llm import conversation_repair as m
from bourse.llm.common import table
from tests.conftest import SF001

SOLID = re.compile(r"[^\x20\x09-\x0D]")


def _least(rows):
    """(cost, edits, roles) by trying every edit, inserts up to two in a row."""
    @functools.cache
    def best(i, state, room):
        out = []
        nxt, role = (3, "a") if state == 2 else (2, "u")
        if i == len(rows):
            if state in (0, 3):
                out.append((0, "", ()))
        else:
            initial, fault = rows[i]
            c, e, r = best(i + 1, state, 2)
            out.append((c + 2, "D" + e, r))
            if fault not in (1, 2):
                extra = 5 if fault == 3 else 0
                keep = {("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3, ("s", 0): 1}.get((initial, state))
                if keep is not None:
                    c, e, r = best(i + 1, keep, 2)
                    out.append((c + extra, "K" + e, ((i, None), *r)))
                c, e, r = best(i + 1, nxt, 2)
                out.append((c + extra + 1, "R" + e, ((i, role), *r)))
        if room:
            c, e, r = best(i, nxt, room - 1)
            out.append((c + 5, "I" + e, ((None, role), *r)))
        return min(out, key=lambda x: x[:2]) if out else (10**9, "", ())
    return best(0, 0, 2)


def _report(rows):
    """The whole report by plain Python."""
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, [])
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        code = zlib.crc32(key.encode()) % 20
        was = (t is not None, t or 0, " " if role is None else role, " " if text is None else text)
        if code == 0:
            continue
        new = "user" if code == 4 else was[2]
        body = "" if code == 1 else re.sub("[.!?]", "", was[3]) if code == 2 else was[3]
        convs[c] += [(*was, new, body, t)] * (2 if code == 3 else 1)
    out = []
    for c, own in convs.items():
        own = sorted(own, key=lambda r: r[:4])
        turns = [r[6] for r in own if r[6] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for *_, role, text, _ in own:
            solid = SOLID.findall(text)
            faults.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
            seen.add((role, text))
        firsts = [r[4][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(firsts))
        cost, audit, made = _least(tuple(zip(firsts, faults))) if own else (0, "", ())
        lines = [f"{m.ROLES[r] if r else own[i][4]}:{own[i][5] if i is not None else ''}" for i, r in made]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((c, gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, digest))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in m.repair_damaged(df).collect()), key=str)


@pytest.mark.parametrize("segment", [m.SEGMENT, 2])
def test_against_all_edits(spark, monkeypatch, segment):
    monkeypatch.setattr(m, "SEGMENT", segment)
    df = table(spark, SF001, "conversations")
    want = _report([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    got = _got(df)
    assert got == want
    assert len({w[7] for w in want}) > 5


def test_odd_rows(spark):
    """Nulls, ties, repeated rows, unknown and empty roles, long texts, and
    extra columns whose names the operator uses."""
    rows = [(None, 1, "user", "a."), (None, None, "assistant", "b!"), (1, None, None, None), (2, 3, "user", None), (3, 1, "", "x?"),
            (4, 1, "tool", "Done. \t\n"), (4, 2, "user", "u" * 300_000 + "."), (5, 1, "user", "q?"), (5, 1, "user", "q?"),
            (5, 1, "assistant", "r."), (5, 9, "assistant", "r"), (6, 2, "system", "s."), (6, 4, "system", "s2."), (7, 1, "user", " \n")]
    rows += [(k, t, r, f"{r} {k} {t}{e}") for k in range(20, 60) for t, (r, e) in enumerate(
        zip(random.Random(k).choices(["system", "user", "assistant"], k=9), random.Random(-k).choices([".", ""], [3, 1], k=9)))]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                               "conv_id long, turn long, role string, text string, conv int, place int, segment int")
    assert _got(df) == _report(rows)


def test_empty_table(spark):
    assert _got(table(spark, SF001, "conversations").filter("1 = 0")) == []


def test_long_conversation_in_segments(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(k, t, rng.choice(["system", "user", "assistant", "tool"]), f"{rng.randrange(9)} words{rng.choice(['.', '.', ''])}")
            for k in (1, 2) for t in range(150)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = _report(rows)
    for size in (256, 16, 1):
        monkeypatch.setattr(m, "SEGMENT", size)
        assert _got(df) == want


def test_search_against_all_edits():
    rng = random.Random(1)
    for n in range(1, 9):
        for _ in range(150):
            rows = [(rng.choice("suat"), rng.choice([0, 0, 1, 2, 3])) for _ in range(n)]
            cost, edits, _ = m.cheapest(rows)
            assert (cost, "".join(e for x in edits for e, _ in x)) == _least(tuple(rows))[:2]


def test_long_search_is_quick():
    rng = random.Random(2)
    rows = [(rng.choice("uuaas"), rng.choice([0, 0, 0, 1, 3])) for _ in range(256)]
    cost, edits, _ = m.cheapest(rows)
    assert cost == _least(tuple(rows))[0] and len(edits) == 256


def test_repaired_rows_follow_the_pattern(spark):
    df = table(spark, SF001, "conversations")
    edited, report = m.repair_conversations(m.damaged(df), [F.asc("order_role"), F.asc("order_hash"), F.asc("order_copy")])
    out = {}
    for r in sorted(m.repaired(edited).collect(), key=lambda r: (r.conv_id, r.place, r.step)):
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    digests = {r.conv_id: r.repaired_sha256 for r in report.collect()}
    for c, lines in out.items():
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in lines))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest() == digests[c]
    assert len(out) > 50
