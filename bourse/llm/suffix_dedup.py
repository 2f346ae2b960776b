"""Repeated passages by sorting suffixes: deep-shallow sorting of the suffixes
(and reversed prefixes) at content-chosen places.

A window of WINDOW bytes is repeated if the same bytes also start anywhere
else. To sort only few suffixes, each window chooses one place: its leftmost
smallest GRAM-byte hash (winnowing). Equal windows choose alike, so places
are grouped by that hash, and only groups of two or more matter. In a group,
the texts to the right of the places are sorted, and the reversed texts to
the left: multikey quicksort down to SHALLOW bytes, then blind tries for the
groups that still agree. A window that reaches o bytes to the left of its
place is repeated if another place agrees with it for o bytes to the left
and WINDOW - o to the right, which the two orders' common prefix lengths
tell.

A group of more than GROUP surroundings is not sorted by one task. One of
them becomes its centre, and each other one is compared with it alone: how
far the two agree to the left (l) and to the right (r) settles the range of o
from WINDOW - r to l. Beyond that range its partners must part from the
centre where it does, with the same byte, so it goes on in the group of those
that do so on the left, and in that of those that do so on the right. Groups
shrink by the number of different bytes in each round, and small ones are
sorted as above. So a passage that a third of all texts hold, each between
words of its own, costs one comparison a text and round.

Whole texts that have an exact copy are settled by their digests before
that; one text of each such group takes part in the sorting, so groups of
copies of any size count once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import flat_bytes, keyed_texts, list_column, prefix_sums, sorted_groups, span_hashes, steps, stored

WINDOW = 400
GRAM = 64
SHALLOW = 32
CHUNK = 8
# Up to this many different surroundings of a place are compared by pairs.
SMALL = 8
# Equal surroundings are merged before the shuffle, over about so many bytes.
MERGE_BYTES = 32 << 20
# Surroundings that one task sorts.
GROUP = 2048
_SLICE = 1 << 21


# ---- places ------------------------------------------------------------------

def places(flat: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in ``flat``) that windows of the texts choose, and the hash
    of the gram there, in ascending order."""
    gram = min(GRAM, window)
    reach = window - gram + 1
    out_at, out_hash = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for lo in range(0, max(0, len(flat) - window + 1), _SLICE):
        part = flat[lo:lo + _SLICE + window - 1]
        starts = np.arange(len(part) - gram + 1)
        h = span_hashes(prefix_sums(part, lower=False), starts, starts + gram)
        low = h >> np.uint64(22) << np.uint64(22) | starts.astype(np.uint64)  # of equal hashes the leftmost
        width = 1
        while width * 2 <= reach:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < reach:
            low = np.minimum(low[:len(low) - (reach - width)], low[reach - width:])
        first = np.arange(lo, lo + len(low))
        text = np.searchsorted(offsets, first, side="right") - 1
        chosen = (low[first + window <= offsets[text + 1]] & np.uint64((1 << 22) - 1)).astype(np.int64)
        if len(chosen):
            chosen = chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))]
            out_at.append(chosen + lo)
            out_hash.append(h[chosen])
    at, hashes = np.concatenate(out_at), np.concatenate(out_hash)
    at, first = np.unique(at, return_index=True)
    return at, hashes[first]


def _places(window: int):
    def run(batches):
        for batch in steps(batches):
            flat, offsets = flat_bytes(batch.column("text"))
            at, h = places(flat, offsets, window)
            text = np.searchsorted(offsets, at, side="right") - 1
            per = np.bincount(text, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("rid", "h1", "h2")] +
                [pa.array(np.diff(offsets)), list_column((at - offsets[text]), per, pa.int64()),
                 list_column(h.view(np.int64), per, pa.int64())], names=["rid", "h1", "h2", "n", "at", "gram"])
    return run


def _surroundings(window: int):
    """What windows around the places can reach: a row for each of the
    different surroundings among about MERGE_BYTES, with all its places."""
    def run(batches):
        reach = window - min(GRAM, window)
        same: dict[tuple, tuple[list[int], list[int]]] = {}
        held = 0
        for batch in steps(batches):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for rid, text, found in zip(batch.column("rid").to_pylist(), texts, batch.column("places").to_pylist()):
                for p in found:
                    a = p["at"]
                    lo = max(0, a - reach)
                    key = p["gram"], a - lo, text[lo:a + window]
                    who = same.get(key)
                    if who is None:
                        who = same[key] = [], []
                        held += len(key[2]) + 300
                    who[0].append(rid)
                    who[1].append(a)
                    held += 80
            if held > MERGE_BYTES:
                yield from _merged(same)
                same, held = {}, 0
        yield from _merged(same)
    return run


def _merged(same):
    keys = list(same)
    for lo in range(0, len(keys), 5_000):
        cut = keys[lo:lo + 5_000]
        gram, left, around = zip(*cut)
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.int64()), pa.array([same[k][0] for k in cut], pa.list_(pa.int64())),
             pa.array([same[k][1] for k in cut], pa.list_(pa.int64())), pa.array(left, pa.int32()), pa.array(around, pa.binary())],
            names=["gram", "rid", "at", "left", "around"])


# ---- deep-shallow sorting ------------------------------------------------------

def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8


def blind_trie(strings: list[bytes], group: list[int]) -> list[tuple[int, int]]:
    """Order a group: (index, common prefix with the one before), from a trie
    that keeps only the branching places. A string goes down by its branching
    bytes alone, is compared once with the leaf it reaches, and its branch is
    set where they part."""
    root: object = [group[0]]  # a leaf: equal strings; a tuple (depth, branches) else
    for i in group[1:]:
        s = strings[i]
        node = root
        while isinstance(node, tuple):
            depth, branches = node
            node = branches.get(s[depth] if depth < len(s) else -1) or next(iter(branches.values()))
        other = strings[node[0]]
        depth = common(s, other)
        if depth == len(s) == len(other):
            node.append(i)
            continue
        above, node = None, root
        while isinstance(node, tuple) and node[0] < depth:
            above, byte = node, s[node[0]] if node[0] < len(s) else -1
            node = node[1][byte]
        byte = s[depth] if depth < len(s) else -1
        if isinstance(node, tuple) and node[0] == depth:
            node[1][byte] = [i]
            continue
        new = (depth, {other[depth] if depth < len(other) else -1: node, byte: [i]})
        if above is None:
            root = new
        else:
            above[1][s[above[0]] if above[0] < len(s) else -1] = new
    out: list[tuple[int, int]] = []
    stack: list[tuple[object, int]] = [(root, 0)]  # with the common prefix to what comes before
    while stack:
        node, before = stack.pop()
        if isinstance(node, tuple):
            depth, branches = node
            keys = sorted(branches)
            stack += [(branches[k], depth) for k in reversed(keys[1:])] + [(branches[keys[0]], before)]
        else:
            out.append((node[0], before))
            out += [(i, len(strings[i])) for i in node[1:]]
    return out


def deep_shallow(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Sorted order of byte strings, and the common prefix of each with the
    one before it (0 for the first)."""
    order: list[int] = []
    prefix: list[int] = []

    def put(pairs) -> None:
        for k, (i, lcp) in enumerate(pairs):
            prefix.append(lcp if k else common(strings[order[-1]], strings[i]) if order else 0)
            order.append(i)

    stack = [(list(range(len(strings))), 0)]
    while stack:  # multikey quicksort, CHUNK bytes as a key
        group, depth = stack.pop()
        if len(group) < 2:
            put([(i, 0) for i in group])
        elif depth >= SHALLOW:
            put(blind_trie(strings, group))
        else:
            pivot = strings[group[len(group) // 2]][depth:depth + CHUNK]
            less, same, more = [], [], []
            for i in group:
                key = strings[i][depth:depth + CHUNK]
                (same if key == pivot else less if key < pivot else more).append(i)
            stack.append((more, depth))
            if len(pivot) < CHUNK:  # they end here, all alike
                stack.append((same, SHALLOW))
            else:
                stack.append((same, depth + CHUNK))
            stack.append((less, depth))
    return order, prefix


def _ranges(hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true entries as (first, last)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [(a, b - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]


def repeated_reaches(lefts: list[bytes], rights: list[bytes], window: int, reach: int) -> list[list[tuple[int, int]]]:
    """For different surroundings of one gram: the ranges of o for which the
    window with o bytes to the left of the gram is also another's. ``lefts``
    are reversed."""
    n = len(lefts)
    if n <= SMALL:
        out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        order, prefix = deep_shallow(rights)
        for i in range(n):
            low = window
            for j in range(i + 1, n):
                low = min(low, prefix[j])
                if low + reach < window:
                    break
                a, b = order[i], order[j]
                left = min(common(lefts[a], lefts[b]), reach)
                if left + low >= window:
                    out[a].append((window - low, left))
                    out[b].append((window - low, left))
        return out
    by_right, right = deep_shallow(rights)
    by_left, left = deep_shallow(lefts)
    hit = np.zeros((n, reach + 1), bool)
    for lo in range(0, reach + 1, 64):
        o = np.arange(lo, min(lo + 64, reach + 1))
        key = np.empty((n, len(o)), np.int64)
        key[by_right] = np.cumsum(np.array(right)[:, None] < window - o, axis=0)
        side = np.empty_like(key)
        side[by_left] = np.cumsum(np.array(left)[:, None] < o, axis=0)
        key = key * (n + 1) + side
        rank = np.argsort(key, axis=0, kind="stable")
        s = np.take_along_axis(key, rank, axis=0)
        twin = np.zeros(s.shape, bool)
        twin[1:] = s[1:] == s[:-1]
        twin[:-1] |= twin[1:]
        np.put_along_axis(hit[:, lo:lo + len(o)], rank, twin, axis=0)
    return [_ranges(row) for row in hit]


def _spans(window: int):
    reach = window - min(GRAM, window)

    def run(batches):
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0
        settled: list[pa.RecordBatch] = []
        for _, group in sorted_groups(_open_rows(batches, settled, window), "gram"):
            yield from settled
            settled.clear()
            if group.num_rows == 1 and len(group.column("at")[0]) == 1:
                continue
            same: dict[tuple[int, bytes], list[tuple[np.ndarray, np.ndarray]]] = {}
            for rid, at, left, around in zip(group.column("rid"), group.column("at"), *(group.column(c).to_pylist() for c in ("left", "around"))):
                same.setdefault((left, around), []).append((rid.values.to_numpy(), at.values.to_numpy()))
            keys = list(same)
            if len(keys) > 1:
                ranges = repeated_reaches([a[:k][::-1] for k, a in keys], [a[k:] for k, a in keys], window, reach)
            else:
                ranges = [[]]
            for (left, around), found in zip(keys, ranges):
                who = same[left, around]
                if len(who) > 1 or len(who[0][1]) > 1:
                    found = [(max(0, window - (len(around) - left)), min(left, reach))]
                for least, most in found:
                    if least <= most:
                        for rid, at in who:
                            out.append((rid, at - most, at - least + window))
                            n += len(rid)
                            if n > 50_000:
                                yield from _span_batches(out)
                                out, n = [], 0
        yield from settled
        yield from _span_batches(out)
    return run


def _open_rows(batches, settled: list[pa.RecordBatch], window: int):
    """The rows whose range of o isn't known yet; the others' spans go to
    ``settled``."""
    for batch in batches:
        known = batch.column("least").is_valid()
        if known.true_count:
            done = batch.filter(known)
            many = done.column("rid").value_lengths().to_numpy()
            at = done.column("at").flatten().to_numpy()
            least, most = (np.repeat(done.column(c).to_numpy(), many) for c in ("least", "most"))
            settled.extend(_span_batches([(done.column("rid").flatten().to_numpy(), at - most, at - least + window)]))
            batch = batch.filter(pc.invert(known))
        yield batch


def _span_batches(spans):
    if spans:
        cols = [np.concatenate(x) for x in zip(*spans)]
        for lo in range(0, len(cols[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + 50_000], pa.int64()) for c in cols], names=["rid", "start", "end"])


_COMPARED = ("key long, rid array<long>, at array<long>, left int, around binary, centre boolean, places int, "
             "least int, most int, on long")


def _against_centre(window: int, reach: int):
    """Each surroundings against its group's centre: a row with the range of
    o that both share (``least`` to ``most``), and a row for each group that
    it goes on in (``on``). Copies of the centre are only marked."""
    def run(batches):
        for batch in batches:
            out = []
            for key, rid, at, left, around, c_left, c_around in zip(*(batch.column(c).to_pylist() for c in (
                    "key", "rid", "at", "left", "around", "c_left", "c_around"))):
                if (left, around) == (c_left, c_around):
                    out.append((key, rid, at, left, around, True, len(rid), None, None, None))
                    continue
                mine, own = (around[:left][::-1], around[left:]), (c_around[:c_left][::-1], c_around[c_left:])
                to_left, to_right = common(mine[0], own[0]), common(mine[1], own[1])
                first, last = max(0, window - len(mine[1])), min(left, reach)
                if max(first, window - to_right) <= min(last, to_left):
                    out.append((key, rid, at, left, None, False, 0, max(first, window - to_right), min(last, to_left), None))
                for side, agreed, open_ in ((0, to_left, last > to_left), (1, to_right, first < window - to_right)):
                    if open_:
                        mark = key.to_bytes(8, signed=True) + bytes((side,)) + agreed.to_bytes(4) + mine[side][:agreed + 1]
                        on = int.from_bytes(hashlib.blake2b(mark, digest_size=8).digest(), signed=True)
                        # Windows that agree for more than this on one side reach less far on the other.
                        rest = window - agreed - 1
                        near = min(left, rest) if side else left
                        part = around[left - near:] if side else around[:left + rest]
                        out.append((None, rid, at, near, part, False, 0, None, None, on))
            cols = list(zip(*out)) or [()] * 10
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.bool_(), pa.int32(),
                     pa.int32(), pa.int32(), pa.int64()]
            names = ["key", "rid", "at", "left", "around", "centre", "places", "least", "most", "on"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
    return run


def _settled_by_centres(entries: DataFrame, window: int, reach: int) -> tuple[DataFrame, DataFrame]:
    """What the large groups among ``entries`` (gram, rid, at, left, around)
    come to: their places with a settled range of o (gram, rid, at, least,
    most), dealt evenly, and the small groups they fall into, as entries."""
    at = stored(entries.withColumnRenamed("gram", "key"), "surroundings")
    spans, small = [], []
    while True:
        size = stored(at.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("rid")).alias("places"), F.min(
            F.struct(F.xxhash64("around", "left"), "left", "around")).alias("c")), "centres")
        few = size.filter("places > 1").filter(F.col("n") <= GROUP).select("key")
        small.append(at.join(few, "key").select(F.col("key").alias("gram"), "rid", "at", "left", "around"))
        many = size.filter(F.col("n") > GROUP).select("key", F.col("c.left").alias("c_left"), F.col("c.around").alias("c_around"))
        if many.isEmpty():
            break
        compared = stored(at.join(many, "key").mapInArrow(_against_centre(window, reach), _COMPARED), "compared")
        shared = compared.filter("least IS NOT NULL")
        # A centre is repeated all over if it has a copy, or else where any other agrees with it.
        copies = stored(compared.filter("centre").groupBy("key").agg(F.sum("places").alias("places")).filter("places > 1")
                        .select("key", F.lit(reach).alias("most"), F.lit(0).alias("least")), "copied")
        reached = shared.join(copies, "key", "left_anti").groupBy("key", "most").agg(F.min("least").alias("least"))
        centres = compared.filter("centre").drop("least", "most") \
            .join(stored(reached.unionByName(copies), "reached"), "key") \
            .withColumn("most", F.least("most", "left")) \
            .withColumn("least", F.greatest("least", window - (F.length("around") - F.col("left"))))
        for found in (shared, centres.filter("least <= most")):
            spans.append(found.select(F.xxhash64("rid", "at", "least").alias("gram"), "rid", "at", "least", "most"))
        at = compared.filter("on IS NOT NULL").select(F.col("on").alias("key"), "rid", "at", "left", "around")
    return _all(spans), _all(small)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _cut(batches):
    for batch in steps(batches):
        rows = []
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        for text, spans in zip(texts, batch.column("spans").to_pylist()):
            gone = union([(s["start"], s["end"]) for s in spans or ()])
            kept, at = [], 0
            for a, b in gone:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            kept = b"".join(kept)
            rows.append((len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(),
                         kept.decode("utf-8", "ignore"), [x for s in gone for x in s]))
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()),
             pa.array(cols[4], pa.string()), pa.array(cols[5], pa.list_(pa.int64()))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "removed"])


def repeated_passages(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is left)
    and removed (starts and ends of the removed runs, flat) for every row of
    ``docs``: without each byte covered by a ``window``-byte string that also
    starts anywhere else. Of a character that a run's edge cuts, the bytes
    left count in kept_sha256 and are left out of text.

    Null and empty texts, and all shorter than ``window``, keep everything.
    Repeated rows are copies of each other. Rows are told apart, and copies
    found, by 64- and 128-bit hashes. A null doc_id passes through; an empty
    table gives an empty result; other columns are ignored.
    """
    texts = keyed_texts(docs, id_col, text_col) \
        .withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text")}) \
        .withColumn("rid", F.xxhash64("doc_id", "h1", "h2"))
    placed = stored(texts.select("rid", "h1", "h2", "text").mapInArrow(
        _places(window), "rid long, h1 long, h2 long, n long, at array<long>, gram array<long>"), "places")

    copies = placed.groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min("rid").alias("one"))
    whole = placed.filter(F.col("n") >= window).select("rid", "h1", "h2", "n") \
        .join(copies.filter("copies > 1"), ["h1", "h2"]).select("rid", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))

    single = placed.join(copies.select(F.col("one").alias("rid")).distinct(), "rid", "left_semi") \
        .select("rid", F.explode(F.arrays_zip("at", "gram")).alias("p")).select("rid", "p.at", "p.gram")
    # Written, so that both sides of the join below are plain shuffles and a
    # hash with a third of the places can be split.
    often = stored(single.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1"), "often")
    shared = single.join(often, "gram")

    def surroundings(of: DataFrame) -> DataFrame:
        per_text = of.groupBy("rid").agg(F.collect_list(F.struct("at", "gram")).alias("places"))
        return texts.select("rid", "text").join(per_text, "rid").mapInArrow(
            _surroundings(window), "gram long, rid array<long>, at array<long>, left int, around binary")

    around = surroundings(shared.filter(F.col("c") <= GROUP))
    if not often.filter(F.col("c") > GROUP).isEmpty():
        settled, small = _settled_by_centres(surroundings(shared.filter(F.col("c") > GROUP)), window, window - min(GRAM, window))
        around = around.unionByName(small).unionByName(settled, allowMissingColumns=True)
    else:
        around = around.withColumns({c: F.lit(None).cast("int") for c in ("least", "most")})
    found = around.repartition("gram").sortWithinPartitions("gram").mapInArrow(_spans(window), "rid long, start long, end long")
    spans = stored(found.unionByName(whole), "spans")

    by_row = spans.groupBy("rid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return texts.select("doc_id", "rid", "text").join(by_row, "rid", "left").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, removed array<long>")
