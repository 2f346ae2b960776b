import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bourse.llm import suffix_dedup as s


def _brute(texts, window):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[p:p + window] for t in texts for p in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - window + 1):
            if seen[t[p:p + window]] > 1:
                gone[p:p + window] = b"\1" * window
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _got(df, **kw):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in s.repeated_passages(df, **kw).collect())


def test_against_all_windows(few):
    rows = few.select("doc_id", "text").collect()
    want = sorted((r.doc_id, *b) for r, b in zip(rows, _brute([r.text for r in rows], 400)))
    assert sum(w[2] for w in want) > 0
    assert _got(few) == want


@pytest.mark.parametrize(("seed", "group"), [(1, s.GROUP), (2, s.GROUP), (3, 2), (4, 8)])
def test_passages_in_many_surroundings(spark, monkeypatch, seed, group):
    """Short windows over texts cut from few passages, with periods; large
    groups settled by centres give the same."""
    monkeypatch.setattr(s, "GROUP", group)
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(6)] + ["xy" * 60, "é" * 50]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts.append(p[a:rng.randint(a, len(p))] if rng.random() < 0.5 else p)
            parts.append(" ".join(word() for _ in range(rng.randint(0, 8))))
        rows.append((i, "".join(parts)))
    want = sorted((i, *b) for (i, _), b in zip(rows, _brute([t for _, t in rows], 90)))
    assert _got(spark.createDataFrame(rows, "doc_id long, text string"), window=90) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=120).map(str.encode), max_size=40), st.integers(0, 40))
def test_deep_shallow_order(strings, same):
    strings = [b"a" * same + x for x in strings]
    order, prefix = s.deep_shallow(strings)
    assert sorted(order) == list(range(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)
    for k in range(1, len(order)):
        a, b = strings[order[k - 1]], strings[order[k]]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefix[k] == n


def test_both_ways_of_comparing_agree(monkeypatch):
    rng = random.Random(5)
    for _ in range(20):
        around = list({("".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode(),
                        ("".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))).encode()) for _ in range(30)})
        lefts, rights = zip(*around)
        got = []
        for small in (0, 1000):
            monkeypatch.setattr(s, "SMALL", small)
            hit = np.zeros((len(around), 9), bool)
            for i, ranges in enumerate(s.repeated_reaches(list(lefts), list(rights), 14, 8)):
                for a, b in ranges:
                    hit[i, a:b + 1] = True
            got.append(hit)
        assert (got[0] == got[1]).all()


def test_equal_surroundings_are_merged_before_the_shuffle():
    """A passage of many texts is sent once, with all its places."""
    passage = "".join(random.Random(1).choice("abcdefgh") for _ in range(2_000)).encode()
    texts = [f"{k:05d}".encode() + passage for k in range(500)]
    found = [{"at": 900, "gram": 3}, {"at": 1_100, "gram": 4}]
    batch = pa.RecordBatch.from_pylist([{"rid": k, "text": t.decode(), "places": found} for k, t in enumerate(texts)])
    sent = pa.Table.from_batches(s._surroundings(400)([batch]))
    none = pa.nulls(sent.num_rows, pa.int32())
    assert sent.num_rows == 2 and sent.column("rid").to_pylist() == [list(range(500))] * 2
    spans = pa.Table.from_batches(s._spans(400)(sent.append_column("least", none).append_column("most", none).to_batches()))
    assert sorted(zip(*spans.to_pydict().values())) == sorted(
        (k, a - 336, a + 400) for k in range(500) for a in (900, 1_100))


def test_hot_passage_meets_in_no_task(spark, monkeypatch):
    """A passage that all texts hold between words of their own: no group
    larger than GROUP is sorted, and the text left is what is hashed."""
    monkeypatch.setattr(s, "GROUP", 20)
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage = word(700)
    rows = [(i, word(rng.randint(0, 500)) + passage + word(rng.randint(0, 500))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sizes, kept = [], s._settled_by_centres

    def settled(entries, window, reach):
        out = kept(entries, window, reach)
        sizes.append((out[0].count(), out[1].groupBy("gram").count().agg({"count": "max"}).first()[0] or 0))
        return out
    monkeypatch.setattr(s, "_settled_by_centres", settled)
    assert _got(df) == sorted((i, *b) for (i, _), b in zip(rows, _brute([t for _, t in rows], 400)))
    assert len(sizes) == 1 and sizes[0][0] >= 120 and sizes[0][1] <= 20
    for r in s.repeated_passages(df).collect():
        left = rows[r.doc_id][1].encode()
        for a, b in reversed(list(zip(r.removed[::2], r.removed[1::2]))):
            left = left[:a] + left[b:]
        assert hashlib.sha256(left).hexdigest() == r.kept_sha256 and left.decode("utf-8", "ignore") == r.text


def test_merged_in_small_steps(few, monkeypatch):
    want = _got(few)
    monkeypatch.setattr(s, "MERGE_BYTES", 1_000)
    assert _got(few) == want


def test_odd_rows(odd):
    rows = odd.select("doc_id", "text").collect()
    got = sorted(s.repeated_passages(odd).collect(), key=str)
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].n_bytes == by[2].n_bytes == 0 and by[4].n_removed == 0
    assert by[6].n_removed == by[6].n_bytes and by[9].n_removed == by[6].n_bytes and by[9].n_spans == 1
    assert by[9].kept_sha256 == hashlib.sha256(b" end").hexdigest()
    assert s.repeated_passages(odd.limit(0)).collect() == []
