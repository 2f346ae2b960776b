"""Each stage of the corpus pipeline against its own input."""

import corpus_pipeline as p
from bourse.llm import decontaminate as d
from bourse.llm.common import table
from tests.conftest import SF0001
from tests.llm.test_minhash_dedup import _brute, _sets
from tests.llm.test_texts import _measures


def _by_id(df):
    rows = df.collect()
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_stages_against_their_input(spark, few):
    items = [(r.item_id, d.normal(r.text)) for r in table(spark, SF0001, "benchmark").collect() if r.text]
    before = _by_id(few)

    passed = _by_id(kept := p.quality(spark, few, SF0001))
    for i, r in before.items():
        n, *_, repeat = _measures(r.text)
        assert not (i in passed and (n < 50 or 100 * repeat > 50 * n))
    assert len(passed) > len(before) // 2 and all(before[i] == r for i, r in passed.items())

    single = _by_id(kept := p.near_duplicate(spark, kept, SF0001))
    ids = list(passed)
    lowest = _brute(ids, _sets([passed[i].text for i in ids]), p.SIMILAR)
    assert set(single) == {i for i in ids if lowest[i] == i} and all(before[i] == r for i, r in single.items())

    clean = _by_id(kept := p.decontaminate(spark, kept, SF0001))
    leaky = {i for i, r in single.items() if any(True for _ in d.Matcher(items, d.EDIT_SHARE).matches(d.normal(r.text)))}
    assert set(clean) == set(single) - leaky and all(before[i] == r for i, r in clean.items())
    assert {i for i, r in single.items() if any(text in d.normal(r.text) for _, text in items)} <= leaky

    redacted = _by_id(kept := p.secrets(spark, kept, SF0001))
    assert set(redacted) == set(clean) and kept.columns == few.columns
    for i, r in redacted.items():
        assert r.n_chars == len(r.text) if r.text != clean[i].text else r == clean[i]

    packed = p.packing(spark, kept, SF0001).collect()
    assert {r.doc_id for r in packed} == set(redacted)
    places = sorted((r.sequence_id, r.offset, r.length) for r in packed)
    for (s, at, n), (t, next_at, _) in zip(places, places[1:]):
        assert next_at == (at + n if s == t else 0)
    assert all(at + n <= 4096 for _, at, n in places)
    pieces = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert pieces(p.run(spark, SF0001).collect()) == pieces(packed)


def test_odd_rows_and_clashing_names(spark, odd):
    named = odd.selectExpr("*", "1 AS key", "2 AS row", "3 AS spans", "4 AS n_chars")
    key = "a secret = 'hunter22hunter' here"
    named = named.unionByName(spark.createDataFrame([(20, key)], "doc_id long, text string"), allowMissingColumns=True)
    for stage in (p.quality, p.near_duplicate, p.decontaminate, p.secrets):
        got = stage(spark, named, SF0001)
        assert got.columns == named.columns and got.limit(0).collect() == []
        assert all((r.key, r.row, r.spans) in ((1, 2, 3), (None, None, None)) for r in got.collect())
        assert stage(spark, named.limit(0), SF0001).collect() == []
    out = {r.doc_id: r for r in p.secrets(spark, named, SF0001).collect()}
    assert "[secret]" in out[20].text and "hunter22" not in out[20].text
    assert out[20].n_chars == len(out[20].text) and out[8].n_chars == 4 and out[1].text is None


def test_near_duplicates_keep_one_row_of_each_class(spark):
    """Rows that share an id but not a text stay; copies without an id go."""
    words = [f"w{k}" for k in range(100)]
    x, near, y = " ".join(words), " ".join([*words[:-1], "z"]), " ".join(f"v{k}" for k in range(50))
    rows = [(5, x), (5, y), (7, near), (None, x), (None, y), (8, None), (9, ""), (9, ""), (None, "one alone"), (None, "one alone")]
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, rid int, class string")
    got = sorted((str(r.doc_id), r.text or "") for r in p.near_duplicate(spark, df, SF0001).collect())
    assert got == sorted([("5", x), ("5", y), ("8", ""), ("9", ""), ("9", ""), ("None", "one alone")])
