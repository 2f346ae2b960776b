import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from bourse.llm import prefix_trie as m
from bourse.llm.common import table
from tests.conftest import SF001


def _rebuilt(rows):
    """{conv_id: [(role, text)]} as the rebuilding rule has it."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(ts)] for c, ts in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def _trie(convs):
    """Rows by walking every prefix."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + (len(members[p]) - 1) * words
        if p:
            up = p[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[p]
            saved[up] = saved.get(up, 0) + saved[p]
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _got(df):
    out = m.prefix_trie(*m.with_shared_openings(m.ordered_turns(df)))
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_against_walked_prefixes(spark):
    df = table(spark, SF001, "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    want = _trie(_rebuilt(rows))
    assert _got(df) == want
    assert max(w[3] for w in want[1:]) > 1


def test_odd_rows(spark):
    """Nulls everywhere, ties, repeated rows and conversations, an absent and
    a short first conversation, a conversation that becomes turnless, and
    extra columns whose names the operator uses."""
    rows = [(0, 1, "user", "a b"), (0, 2, "assistant", "c"), (1, None, None, None), (1, 0, "user", None), (2, 1, "user", "a b"),
            (2, 1, "user", "a b"), (2, 1, "assistant", "a"), (None, 1, "user", "x"), (41, 1, "user", "only"), (45, 3, "user", ""),
            (60, 1, "user", "hi"), (-3, 1, "user", "neg"), (5, 7, "user", " ".join(["long"] * 50_000))]
    rows += [(k, t, "user", f"same {t}") for k in range(61, 75) for t in range(6)]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, id int, depth int, place string")
    # SQL's remainder takes the sign of the id.
    got, want = _got(df.filter("conv_id IS NULL OR conv_id >= 0")), _trie(_rebuilt([r for r in rows if r[0] != -3]))
    assert got == want
    assert len(_got(df)) >= len(want)


def test_empty_table(spark):
    assert _got(table(spark, SF001, "conversations").filter("1 = 0")) == []


@pytest.mark.parametrize("n", [700])
def test_long_chains_in_blocks(spark, monkeypatch, n):
    """Deep unary chains that fork late; sums over many blocks; few rounds."""
    monkeypatch.setattr(m, "BLOCK", 16)
    made = []
    real = m.stored
    monkeypatch.setattr(m, "stored", lambda df, name: made.append(name) or real(df, name))
    rows = [(c, t, "user", f"w{t} x" if t < n - 5 * c else f"own {c} {t}") for c in (0, 1, 2) for t in range(n)]
    rows += [(c + 20, t, "user", "same") for c in range(40) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert _got(df) == _trie(_rebuilt(rows))
    assert made.count("raked") < 30


def test_totals_of_random_trees(spark):
    import random
    rng = random.Random(2)
    for deep in (2, 40):  # bushy, and nearly a chain
        parent = [None] + [max(0, k - 1 - rng.randrange(deep) if deep == 2 else rng.randrange(k)) for k in range(1, 400)]
        depth, kids = [0] * 400, [0] * 400
        for k in range(1, 400):
            depth[k] = depth[parent[k]] + 1
            kids[parent[k]] += 1
        value = [rng.randrange(100) for _ in range(400)]
        want = list(value)
        for k in range(399, 0, -1):
            want[parent[k]] += want[k]
        df = spark.createDataFrame(list(zip(range(400), parent, depth, kids, value)), "id long, parent long, depth long, n_children long, v long")
        assert sorted(tuple(r) for r in m.subtree_totals(df, ["v"]).collect()) == list(enumerate(want))


def test_hot_end_is_hashed_in_blocks(spark):
    ends = spark.range(30_000).select(F.lit(7).cast("decimal(38,0)").alias("id"), F.col("id").alias("conv_id"))
    want = hashlib.sha256(",".join(map(str, range(30_000))).encode()).hexdigest()
    assert [r.ends_sha256 for r in m.end_digests(ends).collect()] == [want]
