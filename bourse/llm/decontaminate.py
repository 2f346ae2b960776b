"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may be hidden by k = m // EDIT_SHARE edits. Cut into
k + 1 pieces, at least one piece of it must stand unchanged in any copy with
up to k edits, at most k places off. One automaton finds all pieces in a
text in one pass; around each hit Myers' bit-parallel algorithm gives the
smallest edit distance of the item to any part of the text there.

The items are the stated query set: they go to the tasks in blocks of
BLOCK_CHARS characters, so memory is bounded for any benchmark.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import keyed_texts, steps

# One edit for this many characters of an item; pieces are about as long.
EDIT_SHARE = 20
BLOCK_CHARS = 8 << 20
SCHEMA = "doc_id long, item_id long, distance int"


def normal(text: str) -> str:
    """Lower case, white space as one space, trimmed."""
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget`` + 1 pieces (fewer, if there are fewer characters) that make
    up the item, with their places."""
    n = min(budget + 1, len(item))
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, budget: int) -> int:
    """Smallest edit distance of ``pattern`` to any part of ``text``; more
    than ``budget`` if all are above it."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for k, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best = m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        # A match may start anywhere: nothing is carried into the first row.
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best = score
            if not best:
                break
    return best if best <= budget else budget + 1


class Matcher:
    def __init__(self, items: list[tuple[int, str]], edit_share: int):
        import ahocorasick
        texts: dict[str, list[int]] = {}
        for item_id, text in items:
            if text:
                texts.setdefault(text, []).append(item_id)
        self.items = [(text, sorted(set(ids)), len(text) // edit_share) for text, ids in texts.items()]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (text, _, budget) in enumerate(self.items):
            for at, piece in pieces(text, budget):
                places.setdefault(piece, []).append((k, at))
        self.find = ahocorasick.Automaton()
        for piece, where in places.items():
            self.find.add_word(piece, (len(piece), where))
        if places:
            self.find.make_automaton()
        self.any = bool(places)

    def matches(self, text: str):
        """(item_id, distance) of every item that ``text`` holds."""
        if not self.any:
            return
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (size, where) in self.find.iter(text):
            for k, at in where:
                item, _, budget = self.items[k]
                lo = end + 1 - size - at - budget
                hi = lo + len(item) + 2 * budget
                runs = windows.setdefault(k, [])
                if runs and lo <= runs[-1][1] - len(item):  # its matches lie in reach of the last hit's
                    runs[-1] = (min(lo, runs[-1][0]), max(hi, runs[-1][1]))
                else:
                    runs.append((lo, hi))
        for k, runs in windows.items():
            item, ids, budget = self.items[k]
            best = min(myers(item, text[max(0, lo):hi], budget) for lo, hi in runs)
            if best <= budget:
                for item_id in ids:
                    yield item_id, best


def _scan(shared, edit_share: int):
    def run(batches):
        matcher = None
        for batch in steps(batches):
            matcher = matcher or Matcher(shared.value, edit_share)
            out = [(doc, item, distance)
                   for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                   for item, distance in matcher.matches(normal(text))]
            doc, item, distance = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(distance, pa.int32())],
                names=["doc_id", "item_id", "distance"])
    return run


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, edit_share: int = EDIT_SHARE, id_col: str = "doc_id",
                      text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, distance for every row of ``docs`` and item whose
    normal text (lower case, single spaces) it holds with at most
    length // ``edit_share`` edits; distance is the smallest.

    Null and empty texts or items match nothing; an item shorter than
    ``edit_share`` must stand unchanged. Items of one normal text match
    together, repeated items once; repeated documents give repeated rows;
    null ids pass through; an empty table on either side gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"),
                             F.col(item_text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text")).alias("chars")).first()["chars"] or 0
    blocks = max(1, -(-size // BLOCK_CHARS))
    texts = keyed_texts(docs, id_col, text_col)
    out = None
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast([(r["item_id"], normal(r["text"])) for r in part])
        found = texts.mapInArrow(_scan(shared, edit_share), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out
