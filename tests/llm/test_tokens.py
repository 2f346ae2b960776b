import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bourse.llm import packing, token_counts
from bourse.llm.encode import UnitEncoder, encoder
from bourse.llm.queries import vocabulary
from bourse.llm.token_files import read_token_ids, token_index, write_token_ids
from bourse.session import shared_dir

PATH = vocabulary()
UNITS = UnitEncoder(PATH)
ODD = ["it's a Test.", "İstanbul ΣΑΣ ŸÿßẞÉé", "a<|endoftext|>b <|startoftext|>", "x\x1cy z w", "é ́e", "12,5!! ...", "",
       "don't!? we'LL", "ﬁne ª º µ ×÷", "a\tb\nc\rd\x0be\x0cf", "é, É. ñ; Ü: ß? ÿ!", "क़ 漢字。日本"]


def _whole(text):
    return encoder(PATH).tokenizer.encode(text, add_special_tokens=False)


def test_units_give_whole_text_ids(docs):
    enc = UnitEncoder(PATH)
    for text in [r.text for r in docs.select("text").collect()][:400] + ODD:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == _whole(text).ids


def test_vocabulary_that_joins_across_spaces(docs):
    """Another vocabulary is used on whole texts."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc = UnitEncoder(path)
    assert UnitEncoder(PATH).by_unit and not enc.by_unit
    for text in [r.text for r in docs.select("text").limit(50).collect()] + ODD:
        whole = enc.tokenizer.encode(text, add_special_tokens=False)
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == whole.ids
        assert token_counts.token_spans(text, path).tolist() == [list(o) for o in whole.offsets]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_units_give_whole_text_ids_any(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert np.frombuffer(encoder(PATH).encode(text), "<u4").tolist() == _whole(text).ids
    assert [tuple(x) for x in token_counts.token_spans(text, PATH).tolist()] == _whole(text).offsets


def _want(rows, end):
    return [(r.doc_id, [*_whole(r.text or "").ids, end]) for r in rows]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs):
    path = shared_dir(spark, "test", "ids")
    write_token_ids(docs, path, PATH)
    start, want = 0, []
    for doc, ids in sorted(_want(docs.collect(), 2)):
        want.append((doc, start, len(ids), _crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, token_index(spark, path).collect())) == want
    back = {r.doc_id: r.ids for r in read_token_ids(spark, path).filter("doc_id in (3, 500)").collect()}
    assert back == {k: v for k, v in _want(docs.collect(), 2) if k in (3, 500)}
    plan = read_token_ids(spark, path).filter("doc_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,3)]" in plan
    # Files hold ascending ranges, and row counts within a file.
    ranges = read_token_ids(spark, path).groupBy("file").agg({"doc_id": "min", "row": "max", "*": "count"}).orderBy("file").collect()
    assert [r["min(doc_id)"] for r in ranges] == sorted(r["min(doc_id)"] for r in ranges)
    assert all(r["max(row)"] == r["count(1)"] - 1 for r in ranges)


def test_token_files_hold_bloom_filters(spark, docs, tmp_path):
    from pyarrow import orc
    path = shared_dir(spark, "test", "ids")
    write_token_ids(docs.repartition(1).limit(300), path, PATH)
    import glob
    files = sorted(glob.glob(path.removeprefix("file:") + "/*.orc"))
    assert files and sum(orc.ORCFile(f).nrows for f in files) == 300
    assert all(orc.ORCFile(f).row_index_stride == 1000 and str(orc.ORCFile(f).compression) == "ZSTD" for f in files)


def test_token_files_odd_rows(spark, odd):
    for df in (odd, odd.limit(0)):
        path = shared_dir(spark, "test", "ids")
        write_token_ids(df, path, PATH)
        got = token_index(spark, path).collect()
        want = _want(df.collect(), 2)
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), len(i), _crc(i)) for d, i in want)
        got.sort(key=lambda r: r.start)
        assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
        known = [r.doc_id for r in got if r.doc_id is not None]
        assert known == sorted(known)


# ---- packing -------------------------------------------------------------------

def _packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark, docs):
    got = [r.asDict() for r in packing.pack(docs, PATH).collect()]
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for doc, ids in _want(docs.collect(), 1):
        parts = sorted(by.pop(doc), key=lambda r: r["piece"])
        assert [(p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in parts] == [
            (k, 4096 * k, len(ids[4096 * k:4096 * (k + 1)]), _crc(ids[4096 * k:4096 * (k + 1)]))
            for k in range(-(-len(ids) // 4096))]
    assert not by
    least = -(-sum(r["length"] for r in got) // 4096)
    assert least <= _packed(got, 4096) <= least * 1.02 + 1


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 200), max_size=25))
def test_plan_is_best_fit(histogram):
    places = packing.plan(histogram, 40)
    rows, ranks = [], {}
    for length, first, last, each, sequence, at in places:
        assert ranks.get(length, 0) == first
        ranks[length] = last
        rows += [{"sequence_id": sequence + k // each, "offset": at + k % each * length, "length": length}
                 for k in range(last - first)]
    assert ranks == histogram
    rooms: list[int] = []
    for length in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
        fit = [r for r in rooms if r >= length]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - length)
        else:
            rooms.append(40 - length)
    assert _packed(rows, 40) == len(rooms)


def test_packing_odd_rows(odd):
    got = packing.pack(odd, PATH, capacity=64).collect()
    _packed(got, 64)
    want = [(str(d), k // 64, len(i[k:k + 64]), _crc(i[k:k + 64])) for d, i in _want(odd.collect(), 1) for k in range(0, len(i), 64)]
    assert sorted((str(r.doc_id), r.piece, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert packing.pack(odd.limit(0), PATH).collect() == []


# ---- counts by section -----------------------------------------------------------

def test_sections_add_up(docs):
    got = {}
    for r in token_counts.section_token_counts(docs, PATH).collect():
        got.setdefault(r.doc_id, {})[r.section] = (r.start, r.end, r.n_tokens)
    for r in docs.collect():
        at = 0
        for k, line in enumerate(r.text.split("\n")):
            assert got[r.doc_id][k] == (at, at + len(line), len(_whole(line).ids))
            at += len(line) + 1
        assert len(got[r.doc_id]) == k + 1


def test_boundary_rule():
    spans = np.array([(0, 2), (2, 5), (5, 9), (9, 12), (14, 16)])
    tokens, crossing = token_counts.attribute(spans, np.array([(0, 4), (4, 7), (7, 7), (7, 13)]))
    # (2, 5) has two places in the first; (5, 9) two in each, so the earlier; (14, 16) lies outside.
    assert tokens.tolist() == [2, 1, 0, 1, 1] and crossing.tolist() == [1, 1, 0, 0, 0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(1, 6), max_size=12), st.integers(0, 3))
def test_attribution_against_each_character(sections, tokens, skip):
    ends = np.cumsum(sections, dtype=np.int64)
    own = np.stack((ends - np.array(sections, np.int64), ends), axis=1) if sections else np.zeros((0, 2), np.int64)
    last = np.cumsum(tokens, dtype=np.int64) + skip
    spans = np.stack((last - np.array(tokens, np.int64), last), axis=1) if tokens else np.zeros((0, 2), np.int64)
    want = [0] * (len(own) + 1)
    for a, b in spans.tolist():
        held = [sum(1 for c in range(a, b) if s <= c < e) for s, e in own.tolist()]
        want[held.index(max(held)) if held and max(held) else -1] += 1
    assert token_counts.attribute(spans, own)[0].tolist() == want


def test_sections_odd_rows(odd):
    got = token_counts.section_token_counts(odd, PATH).collect()
    assert sum(r.n_tokens for r in got) == sum(len(i) - 1 for _, i in _want(odd.collect(), 1))
    assert len(got) == sum(len((r.text or "").split("\n")) for r in odd.collect())
    halves = lambda t: np.array([(0, len(t) // 2)])
    some = token_counts.section_token_counts(odd, PATH, halves).collect()
    assert sum(r.n_tokens for r in some) == sum(r.n_tokens for r in got) and any(r.section == -1 for r in some)
    assert token_counts.section_token_counts(odd.limit(0), PATH).collect() == []


@pytest.mark.parametrize("unit", ["The.", "naïve", "x" * 300])
def test_cache_is_bounded(monkeypatch, unit):
    import bourse.llm.encode as e
    monkeypatch.setattr(e, "KEPT_UNITS", 1)
    enc = UnitEncoder(PATH)
    for _ in range(2):
        assert np.frombuffer(enc.encode(unit), "<u4").tolist() == _whole(unit).ids
    assert len(enc.cache) == 1


def test_packing_keeps_few_units_in_a_process(monkeypatch):
    import pyarrow as pa
    import bourse.llm.encode as e
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(k, k + 60)) for k in range(0, 600, 60)]
    want = [(i, len(_whole(t).ids) + 1) for i, t in enumerate(texts)]
    for text in texts:  # as another operator leaves it
        encoder(PATH).encode(text)
    assert len(e._ENCODERS[PATH].cache) > 500
    monkeypatch.setattr(packing, "KEPT_UNITS", 40)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    got = [r for out in packing._pieces(PATH, 1, 4096)([batch]) for r in out.to_pylist()]
    assert [(r["doc_id"], r["length"]) for r in got] == want
    assert len(e._ENCODERS[PATH].cache) <= 40


def test_signs_after_a_word_are_made_once(monkeypatch):
    """The whole tokenizer sees each run of signs once, not every word that one follows."""
    enc = UnitEncoder(PATH)
    enc.forget()
    seen, whole = [], enc._whole
    monkeypatch.setattr(enc, "_whole", lambda unit: seen.append(unit) or whole(unit))
    text = " ".join(f"{w}{run}" for w in ("thanea", "Ciónes", "straße", "ONA") for run in ("$$$", ".***", ",&&&", "''", "@", "|>"))
    assert np.frombuffer(enc.encode(text), "<u4").tolist() == _whole(text).ids
    assert len(seen) == len(set(seen)) <= 6


def test_kept_runs_are_bounded(monkeypatch):
    import bourse.llm.encode as e
    monkeypatch.setattr(e, "KEPT_RUNS", 2)
    enc = UnitEncoder(PATH)
    for text in ("a!! b?? c;; d!!", "e?? f## g;; É@@"):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == _whole(text).ids
    assert len(enc.runs) == 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aZéÉßẞsStT'’.,!?$*&%<>|_^`~-3 ̸́", max_size=8), max_size=6))
def test_words_and_signs_give_whole_text_ids(units):
    text = " ".join(units)
    assert np.frombuffer(UNITS.encode(text), "<u4").tolist() == _whole(text).ids


def test_token_files_are_read_once(spark, docs):
    """The index is laid out from a table of counts, not from the ids again."""
    path = shared_dir(spark, "bourse", "token_ids")
    write_token_ids(docs.limit(50), path, PATH)
    index = token_index(spark, path)
    assert index.count() == 50
    assert index.inputFiles() and not [f for f in index.inputFiles() if path.rsplit("/", 1)[1] in f]
