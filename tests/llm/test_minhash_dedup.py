import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bourse.llm import minhash_dedup as m
from bourse.llm.components import connected_components


def _sets(texts):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def _brute(ids, sets, percent=85):
    low = list(range(len(ids)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    by = {}
    for k, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(k)
    pairs = {}
    for k, s in enumerate(sets):
        near = {}
        for x in s:
            for j in by[x]:
                if j < k:
                    near[j] = near.get(j, 0) + 1
        for j, both in near.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(j), find(k)
                low[max(a, b)] = min(a, b)
                pairs[j, k] = both
    groups = {}
    for k in range(len(ids)):
        groups.setdefault(find(k), []).append(ids[k])
    return {i: min(g) for g in groups.values() for i in g}


def test_against_all_pairs(docs):
    rows = docs.select("doc_id", "text").collect()
    sets = _sets([r.text for r in rows])
    want = _brute([r.doc_id for r in rows], sets)
    got = m.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {r.doc_id: len(s) for r, s in zip(rows, sets)}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert 0 < sum(not r.kept for r in got) < len(got) // 2


def test_large_cluster_in_blocks(spark, monkeypatch):
    """A group of near copies larger than a block: same classes."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for k in rng.choice(120, rng.integers(0, 5), replace=False):
            words[k] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(words)))
    want = _brute([i for i, _ in rows], _sets([t for _, t in rows]))
    assert 1 < len(set(want.values())) < 90
    monkeypatch.setattr(m, "BLOCK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in m.near_duplicates(df).collect()} == want


def test_near_copies_of_a_centre_are_sent_twice_at_most(spark, monkeypatch):
    """Thousands of different near copies: every one is linked with its
    centre, and nothing is left for the comparison in blocks."""
    base = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join([*base[:i % 300], f"x{i}", *base[i % 300 + 1:]])) for i in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sent, real = [], m._packed_sets
    monkeypatch.setattr(m, "_packed_sets", lambda texts, one, wanted: sent.append(
        wanted.select(F.size("pairs").alias("n")).agg({"n": "sum"}).first()[0] or 0) or real(texts, one, wanted))
    assert {r.component_id for r in m.near_duplicates(df).collect()} == {0}
    assert 3_000 <= sent[0] <= 2 * 3_000 and sent[1] == 0


def test_strays_in_blocks(spark, monkeypatch):
    """Nodes outside the largest class meet all others, in blocks."""
    rng = np.random.default_rng(12)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(140):
        words = list(base)
        for k in rng.choice(150, int(rng.integers(0, 9)) if i % 2 else 1, replace=False):
            words[k] = f"x{rng.integers(60)}"
        rows.append((i, " ".join(words)))
    want = _brute([i for i, _ in rows], _sets([t for _, t in rows]))
    assert 2 < len(set(want.values())) < 140
    for block in (8, 512):
        monkeypatch.setattr(m, "BLOCK", block)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert {r.doc_id: r.component_id for r in m.near_duplicates(df).collect()} == want


def test_signature_estimates_similarity():
    a = [f"w{k}" for k in range(400)]
    b = a[:200] + [f"v{k}" for k in range(200)]
    sets, counts = m.shingle_sets(pa.array([" ".join(a), " ".join(b), "one two", "one"]))
    assert counts.tolist() == [396, 396, 1, 1]
    s = m.signatures(sets, counts)
    assert abs((s[0] == s[1]).mean() - 196 / 596) < 0.08
    assert len(set(s[2].tolist())) == 1 and not (s[2] == s[3]).any()


def test_odd_rows(spark, odd):
    got = m.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_shingles for k in (1, 2, 3) for r in by[k]] == [0, 0, 0]
    assert all(by[k][0].component_id == k for k in (1, 2, 3, 7, 8))
    assert [r.component_id for r in by[4]] == [4, 4] and by[5][0].component_id == 4 and not by[5][0].kept
    assert sorted(str(r.component_id) for r in by[None]) == ["4", "None"]
    assert by[9][0].component_id == 6
    assert m.near_duplicates(odd.limit(0)).collect() == []


def test_shared_and_null_ids(spark):
    """Rows that share an id keep their own texts, in every order; rows
    without an id are compared as well. Each order has ids and words of its own."""
    cases = [([(5, "x"), (5, "y"), (7, "near")], {(5, "x"): 5, (5, "y"): 5, (7, "near"): 5}),
             ([(5, "y"), (4, "x"), (7, "near"), (5, "x")], {(5, "y"): 5, (4, "x"): 4, (7, "near"): 4, (5, "x"): 4}),
             ([(1, "x"), (None, "near")], {(1, "x"): 1, (None, "near"): 1}),
             ([(None, "x"), (None, "near"), (3, "y")], {(None, "x"): None, (None, "near"): None, (3, "y"): 3})]
    rows, want = [], {}
    for n, (order, classes) in enumerate((o, w) for rs, w in cases for o in itertools.permutations(rs)):
        words = [f"w{n}_{k}" for k in range(200)]
        text = {"x": " ".join(words), "near": " ".join([*words[:-1], "z"]), "y": " ".join(f"v{n}_{k}" for k in range(50))}
        moved = lambda i, n=n: None if i is None else 100 * n + i
        rows += [(moved(i), text[t]) for i, t in order]
        want |= {(moved(i), text[t]): moved(c) for (i, t), c in classes.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    keys = {r.rid: (r.doc_id, r.text) for r in df.withColumn("rid", m.row_key()).collect()}
    assert {keys[r.rid]: r.component_id for r in m.near_duplicate_rows(df).collect()} == want


def test_components(spark):
    chain = [(k, k + 1) for k in range(100, 160)] + [(7, 7), (3, 9), (9, 3), (9, 200)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**{k: 100 for k in range(100, 161)}, 7: 7, 3: 3, 9: 3, 200: 3}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_contracted_stars_keep_components(spark):
    rng = np.random.default_rng(8)
    stars = [(int(a), int(a + b)) for a, b in zip(rng.integers(0, 300, 400), rng.integers(1, 40, 400))]
    df = spark.createDataFrame(stars, "a long, b long").distinct()
    less = m.contracted(df)
    assert less.count() <= df.count() + 400
    assert sorted(connected_components(less).collect()) == sorted(connected_components(df).collect())
