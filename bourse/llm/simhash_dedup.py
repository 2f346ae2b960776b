"""Near-duplicates by SimHash: 64-bit fingerprints, found within a Hamming
radius by BK-trees.

1. One pass over the texts gives each its fingerprint. Texts with one
   fingerprint count once from here on.
2. Fingerprints are dealt to shards so that any two within the radius meet
   in at least one: the bits are cut into radius + 1 blocks, and two
   fingerprints that differ in at most radius bits agree on a whole block.
   A shard holds the fingerprints that agree on one block. A shard of more
   than SHARD fingerprints is cut again by the same rule on the bits left,
   until it is small enough or so few bits are left (at most 12 at radius 3)
   that it can't hold more than 2**12 fingerprints. Only large shards are
   dealt anew, so nothing is compared with a whole large group and no
   candidate is dropped.
3. In each shard a BK-tree is grown: a node's children are keyed by their
   Hamming distance to it. Each fingerprint looks up its neighbours before
   it goes in, following only edges within the radius of its distance to
   the node. The tree gives the edges of a spanning forest of its links, at
   most one a fingerprint, never the pairs of a group.
4. The components of these edges are the classes.

Trees stay where their shard is: a tree of all fingerprints would have to
pass through the driver to be broadcast, and its size has no bound.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import keyed_texts, stored
from bourse.llm.components import connected_components

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
# Fingerprints of a shard that isn't cut again.
SHARD = 512
# Deepest cut; at radius 3 it leaves at most 12 bits.
DEPTH = 6
# Bytes of text cut into words at a time.
PIECE = 1 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_GAP = re.compile(rb"[\x20\x09-\x0D]")


# ---- fingerprints --------------------------------------------------------------

def _word_lists(text: bytes, overlap: int):
    """Words of ``text``, about PIECE bytes at a time; each list after the
    first begins with the last ``overlap`` words of those before it."""
    last: list[bytes] = []
    lo = 0
    while lo < len(text):
        gap = _GAP.search(text, lo + PIECE)
        hi = gap.start() if gap else len(text)
        # bytes.split() cuts at exactly the six ASCII white-space characters.
        words = last + text[lo:hi].translate(_LOWER).split()
        yield words
        last = words[max(0, len(words) - overlap):]
        lo = hi


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's shingles of ``size`` words, repeats included:
    a bit is 1 if set in over half of their XXH64 values."""
    ones = np.zeros(BITS, np.int64)
    total = 0
    short: list[bytes] = []
    for words in _word_lists(text, size - 1):
        if len(words) < size:
            short = words
            continue
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        ones += _bit_counts(hashes)
        total += len(hashes)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(short), SEED) if short else 0
    return int((2 * ones > total) @ (np.uint64(1) << np.arange(BITS, dtype=np.uint64)))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the values have each bit, lowest bit first."""
    out = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 16_384):
        bits = np.unpackbits(hashes[lo:lo + 16_384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += bits.sum(axis=0, dtype=np.int64)
    return out


def _fingerprints(size: int):
    def run(batches):
        for batch in batches:
            marks = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", size)
                     for t in batch.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(marks, np.uint64).view(np.int64))], names=["doc_id", "mark"])
    return run


# ---- shards --------------------------------------------------------------------

def _cuts(radius: int) -> list[list[tuple[int, int]]]:
    """For each depth, the (parent path, mask) of every shard path: a path's
    number is its place in the list, its mask the bits its members share."""
    paths = [[(0, 0)]]
    left = [list(range(BITS))]
    for _ in range(DEPTH):
        level, rest = [], []
        for parent, (bits, (_, mask)) in enumerate(zip(left, paths[-1])):
            for block in np.array_split(np.array(bits), radius + 1):
                level.append((parent, mask | sum(1 << int(b) for b in block)))
                rest.append([b for b in bits if b not in set(block.tolist())])
        paths.append(level)
        left = rest
    return paths


def _shards(marks: DataFrame, radius: int) -> DataFrame:
    """(path, shared, mark): every fingerprint under each of its shards of a
    size to grow a tree of."""
    spark = marks.sparkSession
    paths = _cuts(radius)
    signed = np.array([m for level in paths for _, m in level], np.uint64).view(np.int64).tolist()
    dealt, ready, at = marks.select(F.lit(0).alias("path"), "mark"), [], 1
    for depth in range(1, DEPTH + 1):
        level = paths[depth]
        # A fixed table of at most (radius + 1)**DEPTH rows.
        table = spark.createDataFrame([(parent, k, signed[at + k]) for k, (parent, _) in enumerate(level)],
                                      "path int, child int, mask long")
        at += len(level)
        dealt = stored(dealt.join(F.broadcast(table), "path").select(
            F.col("child").alias("path"), F.col("mark").bitwiseAND(F.col("mask")).alias("shared"), "mark"), "shards")
        if depth == DEPTH:
            ready.append(dealt.withColumn("depth", F.lit(depth)))
            break
        large = stored(dealt.groupBy("path", "shared").agg(F.count(F.lit(1)).alias("n"))
                       .filter(F.col("n") > SHARD).select("path", "shared"), "large")
        ready.append(dealt.join(large, ["path", "shared"], "left_anti").withColumn("depth", F.lit(depth)))
        if large.isEmpty():
            break
        dealt = dealt.join(large, ["path", "shared"], "left_semi").select("path", "mark")
    out = ready[0]
    for more in ready[1:]:
        out = out.unionByName(more)
    return out.select("depth", "path", "shared", "mark")


# ---- BK-trees ------------------------------------------------------------------

class BKTree:
    """Fingerprints as a tree: a node's children by their distance to it."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, mark: int) -> None:
        if self.root is None:
            self.root = (mark, {})
            return
        value, children = self.root
        while d := (value ^ mark).bit_count():
            if d not in children:
                children[d] = (mark, {})
                return
            value, children = children[d]

    def near(self, mark: int, radius: int):
        """All values in the tree within ``radius`` of ``mark``."""
        todo = [self.root] if self.root else []
        while todo:
            value, children = todo.pop()
            d = (value ^ mark).bit_count()
            if d <= radius:
                yield value
            todo.extend(c for k, c in children.items() if d - radius <= k <= d + radius)


def forest(marks, radius: int):
    """Pairs that link ``marks`` as all pairs within ``radius`` would."""
    tree, low = BKTree(), {}

    def find(x: int) -> int:
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for mark in marks:
        low[mark] = mark
        for other in tree.near(mark, radius):
            a, b = find(mark), find(other)
            if a != b:
                low[a] = b
                yield mark, other
        tree.add(mark)


def _links(radius: int):
    def run(batches):
        held: list[int] = []
        last = None
        for batch in batches:
            names = ("depth", "path", "shared", "mark")
            cols = [batch.column(c).to_numpy() for c in names]
            marks = cols[3].view(np.uint64)
            new = np.ones(batch.num_rows, bool)
            for c in cols[:3]:
                new[1:] &= c[1:] == c[:-1]
            new[1:] = ~new[1:]
            edges: list[tuple[int, int]] = []
            starts = np.flatnonzero(new).tolist()
            for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
                key = tuple(c[lo] for c in cols[:3])
                if key != last:
                    if len(held) > 1:
                        edges.extend(forest(held, radius))
                    held, last = [], key
                held.extend(marks[lo:hi].tolist())
            yield _pairs(edges)
        if len(held) > 1:
            yield _pairs(list(forest(held, radius)))
    return run


def _pairs(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def simhash_duplicates(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE_WORDS,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z. A text of fewer than
    ``size`` words is one shingle of all of them; null, empty and blank texts
    have fingerprint zero, linked like any other. Fingerprints that differ in
    at most ``radius`` bits (3 or more give the bound on shards stated above)
    are linked; component_id is the smallest doc_id reachable. Repeated rows
    stay separate rows of one class. A null doc_id never becomes a
    component_id unless its class has no other; then component_id is null.
    An empty table gives an empty result; other columns are ignored.
    """
    marked = stored(keyed_texts(docs, id_col, text_col).mapInArrow(_fingerprints(size), "doc_id long, mark long"), "marks")
    first = stored(marked.groupBy("mark").agg(F.min("doc_id").alias("first")), "distinct_marks")
    shards = _shards(first.select("mark"), radius)
    keys = ["depth", "path", "shared"]
    links = shards.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_links(radius), "a long, b long")
    classes = connected_components(links.distinct())

    joined = stored(first.join(classes, first.mark == classes.node, "left").select(
        "mark", "first", F.coalesce("component", "mark").alias("class")), "classes")
    lowest = stored(joined.groupBy("class").agg(F.min("first").alias("component_id")), "lowest")
    # Written, so that a fingerprint or class with a third of the rows can be split.
    named = stored(joined.join(lowest, "class").select("mark", "component_id"), "named")
    return marked.join(named, "mark").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")
