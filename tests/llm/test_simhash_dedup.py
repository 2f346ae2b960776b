import random
import re

import xxhash
from pyspark.sql import functions as F

from bourse.llm import simhash_dedup as m


def _mark(text):
    low = re.sub(r"[A-Z]", lambda c: c[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    s = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(rows, radius=3):
    """{mark: smallest id reachable} by all pairs."""
    ids = {}
    for i, mark in rows:
        ids.setdefault(mark, []).append(i)
    marks = sorted(ids)
    low = {x: x for x in marks}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for k, a in enumerate(marks):
        for b in marks[:k]:
            if (a ^ b).bit_count() <= radius:
                low[find(a)] = find(b)
    best = {}
    for x in marks:
        got = [i for i in ids[x] if i is not None]
        if got:
            best[find(x)] = min(min(got), best.get(find(x), min(got)))
    return {x: best.get(find(x)) for x in marks}


def _check(docs, got):
    rows = [(r.doc_id, _mark(r.text)) for r in docs.select("doc_id", "text").collect()]
    want = _classes(rows)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == \
        sorted(((i, f"{x:016x}", want[x]) for i, x in rows), key=str)
    return want


def test_against_all_pairs(docs):
    want = _check(docs, m.simhash_duplicates(docs).collect())
    assert len(want) < docs.count()  # exact copies


def test_near_copies(spark):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(5_000)}" for _ in range(400)]
        rows += [(3 * k + 1, " ".join(words)), (3 * k, " ".join([*words[:-1], "other"])),
                 (3 * k + 2, " ".join([*words[:200], "cut", *words[201:]]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = _check(df, m.simhash_duplicates(df).collect())
    assert len(set(want.values())) < 120 < len(want)


def test_odd_rows(odd):
    _check(odd, m.simhash_duplicates(odd).collect())


def test_empty_table(odd):
    assert m.simhash_duplicates(odd.filter("1 = 0")).count() == 0


def test_spark_hash_gives_the_same_bits(spark):
    text = "ein kurzer Satz"
    got = spark.range(1).select(F.xxhash64(F.lit(text.lower())).alias("h")).first().h
    assert m.fingerprint(text.encode()) == got % 2**64


def test_pieces_of_a_long_text(monkeypatch):
    text = " ".join(f"Wort{k % 97}\t\nz{k}" for k in range(3_000))
    whole = m.fingerprint(text.encode())
    monkeypatch.setattr(m, "PIECE", 100)
    assert m.fingerprint(text.encode()) == whole == _mark(text)
    assert m.fingerprint(b"  one  ") == _mark("one")


def test_every_close_pair_meets_in_a_shard():
    rng = random.Random(4)
    paths = m._cuts(3)
    assert [len(p) for p in paths] == [4**k for k in range(m.DEPTH + 1)]
    assert all(64 - mask.bit_count() <= 12 for _, mask in paths[-1])
    for _ in range(2_000):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        chosen = {0}
        for level in paths[1:]:  # at each depth some child of a shared shard is shared
            chosen = {k for k, (parent, mask) in enumerate(level) if parent in chosen and not mask & diff}
            assert chosen


def test_tree_finds_all_within_radius():
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(20)]
    marks = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(30)})
    tree = m.BKTree()
    for x in marks:
        tree.add(x)
    for x in marks[:100]:
        assert sorted(tree.near(x, 3)) == sorted(y for y in marks if (x ^ y).bit_count() <= 3)


def test_large_shards_are_cut_again(spark, monkeypatch):
    """A group that shares most bits, far above the size of a shard."""
    monkeypatch.setattr(m, "SHARD", 8)
    rng = random.Random(6)
    base = rng.getrandbits(64)
    marks = list({base ^ sum(1 << b for b in rng.sample(range(40, 64), rng.randint(0, 7))) for _ in range(400)}
                 | {rng.getrandbits(64) for _ in range(50)})
    df = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in marks], "mark long")
    shards = m._shards(df, 3)
    sizes = shards.filter(F.col("depth") < m.DEPTH).groupBy("depth", "path", "shared").count()
    assert sizes.agg(F.max("count")).first()[0] <= 8
    assert shards.agg(F.max("depth")).first()[0] > 1
    keys = ["depth", "path", "shared"]
    edges = shards.repartition(3, *keys).sortWithinPartitions(*keys).mapInArrow(m._links(3), "a long, b long").collect()
    low = {x: x for x in marks}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for r in edges:
        a, b = r.a % 2**64, r.b % 2**64
        assert (a ^ b).bit_count() <= 3
        low[find(a)] = find(b)
    want = _classes([(x, x) for x in marks])
    assert {frozenset(y for y in marks if find(y) == find(x)) for x in marks} == \
        {frozenset(y for y in marks if want[y] == want[x]) for x in marks}
