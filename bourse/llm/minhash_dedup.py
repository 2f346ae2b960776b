"""Near-duplicates by MinHash: one permutation, densified bins, banded
buckets, star-shaped candidate edges, and exact confirmation.

Steps, all as Spark jobs:

1. One pass over the texts (numpy on Arrow batches). A text's set holds the
   64-bit hashes of its distinct five-word shingles. The hash's range is cut
   into BINS equal bins; the smallest hash in each bin is the signature
   (one-permutation hashing). An empty bin borrows from the bin that its own
   probe sequence reaches first among the non-empty ones (optimal
   densification). Texts with one set share a *node* (a hash of the set), so
   a group of exact copies counts once from here on.
2. ROWS bins make a band; each band's values make a bucket key. In each
   bucket the smallest node is the centre and every other node gets an edge
   to it: at most one edge per node and band, never the pairs of a bucket.
   The components of these edges are the loose clusters: any two nodes that
   share a bucket are in one.
3. Each node's full set is first compared with its smallest centre's, centre
   by centre (a centre of very many nodes is repeated for parts of them). The
   components of the links found are the first classes. A bucket whose nodes
   are all of one class has nothing more to give: a group of any number of
   near copies that are linked with their centres is settled here, each set
   sent twice at most.
4. Buckets that still hold several classes give the loose clusters: any two
   nodes of different classes that share a bucket are in one. In each, the
   nodes outside its largest class are compared with all others, exactly, in
   blocks of BLOCK nodes that meet two at a time, so no task holds a whole
   large cluster. A block gives the edges of a spanning forest of its links,
   not its pairs. The components of all links are the classes.

Two sets with similarity s share no bucket with probability
(1 - s**ROWS)**(BINS/ROWS), 2e-6 at 0.85. With seven rows it is 1e-5 at 0.8.
Work grows with the square of a loose cluster's number of different sets
outside its largest class; copies, and near copies of a centre, don't count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import keyed_texts, list_column, mix, sorted_groups, steps, stored, word_hashes
from bourse.llm.components import connected_components

SHINGLE_WORDS = 5
BINS = 336
ROWS = 8
BLOCK = 512
PROBES = 1024
_EMPTY = np.uint64(2**64 - 1)
_SIGNED = np.int64

with np.errstate(over="ignore"):
    # Where an empty bin looks, try by try.
    _PROBE = (mix(np.arange(PROBES * BINS, dtype=np.uint64) + np.uint64(0xA5A5)) % np.uint64(BINS)) \
        .astype(np.int64).reshape(PROBES, BINS)
    _PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts end to end, and how many
    each text has. Fewer than ``size`` words make one shingle of all of them."""
    h, owner, *_ = word_hashes(column)
    n = len(column)
    per_text = np.bincount(owner, minlength=n)
    first = np.concatenate(([0], np.cumsum(per_text)[:-1])) if n else np.zeros(0, np.int64)
    counts = np.where(per_text >= size, per_text - size + 1, (per_text > 0).astype(np.int64))
    at = np.repeat(first - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    length = np.repeat(np.minimum(per_text, size), counts)
    out = length.astype(np.uint64) * _PLACE[40]
    padded = np.concatenate((h, np.zeros(size, np.uint64)))
    for k in range(size):
        out += np.where(length > k, padded[at + k] * _PLACE[k], np.uint64(0))
    out = mix(out)
    ends = np.cumsum(counts)
    for lo, hi in zip((ends - counts).tolist(), ends.tolist()):
        out[lo:hi].sort()
    text = np.repeat(np.arange(n), counts)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    return out[new], np.bincount(text[new], minlength=n)


def signatures(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One-permutation MinHash with optimal densification; a row per text
    with a set (texts without one must be left out)."""
    n = len(counts)
    text = np.repeat(np.arange(n), counts)
    slot = text * BINS + ((sets >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(sets), bool)
    first[1:] = slot[1:] != slot[:-1]
    own = np.full(n * BINS, _EMPTY)
    own[slot[first]] = sets[first]
    out = own.copy()
    todo = np.flatnonzero(own == _EMPTY)
    for probe in range(PROBES):
        if not len(todo):
            break
        got = own[todo // BINS * BINS + _PROBE[probe][todo % BINS]]
        out[todo] = got
        todo = todo[got == _EMPTY]
    for k in todo.tolist():  # as good as never: the next bin around the circle
        row = own[k // BINS * BINS:(k // BINS + 1) * BINS]
        full = np.flatnonzero(row != _EMPTY)
        out[k] = row[full[np.searchsorted(full, k % BINS) % len(full)]]
    return out.reshape(n, BINS)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = BINS // rows
    keys = (signature.reshape(-1, bands, rows) * _PLACE[:rows]).sum(axis=2, dtype=np.uint64)
    return mix(keys + np.arange(bands, dtype=np.uint64) * _PLACE[50])


def node_ids(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit id of each text's set (texts with a set only)."""
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    a = np.add.reduceat(mix(sets * _PLACE[51]), starts)
    b = np.add.reduceat(mix(sets ^ _PLACE[52]), starts)
    return mix(a ^ mix(b + counts.astype(np.uint64)))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(_SIGNED)


def _sign(rows: int):
    def run(batches):
        for batch in steps(batches):
            sets, counts = shingle_sets(batch.column("text"))
            have = counts > 0
            node = np.zeros(len(counts), np.int64)
            keys = np.zeros(0, np.uint64)
            if have.any():
                node[have] = _signed(node_ids(sets, counts[have]))
                keys = band_keys(signatures(sets, counts[have]), rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("rid"), pa.array(node, mask=~have), pa.array(counts, type=pa.int64()),
                list_column(_signed(keys.reshape(-1)), have * (BINS // rows), pa.int64())],
                names=["doc_id", "rid", "node", "n_shingles", "bands"])
    return run


def _pack(batches):
    """A text's set as bytes; the other columns pass."""
    for batch in steps(batches):
        sets, counts = shingle_sets(batch.column("text"))
        ends = np.cumsum(counts)
        raw = sets.tobytes()
        packed = [raw[8 * lo:8 * hi] for lo, hi in zip((ends - counts).tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("pairs"),
                                          pa.array(packed, type=pa.binary())], names=["node", "pairs", "shingles"])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs in a block of sets, as products of
    their incidence matrix, a slice of shingles at a time."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    shingle = np.cumsum(new) - 1
    shared = np.bincount(shingle) > 1
    keep = shared[shingle]
    shingle, owner = (np.cumsum(shared) - 1)[shingle[keep]], owner[keep]
    out = np.zeros((len(sets), len(sets)), np.float32)
    total = int(shared.sum())
    for lo in range(0, total, 4096):
        a, b = np.searchsorted(shingle, [lo, lo + 4096])
        m = np.zeros((len(sets), min(4096, total - lo)), np.float32)
        m[owner[a:b], shingle[a:b] - lo] = 1
        out += m @ m.T
    return out


def _links(sets: list[np.ndarray], percent: int):
    """Index pairs of a spanning forest of 100*|intersection| >= percent*|union|."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        if 100 * both >= percent * (len(sets[0]) + len(sets[1]) - both):
            yield 0, 1
        return
    sizes = np.array([len(s) for s in sets], np.float64)
    both = _overlaps(sets).astype(np.float64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    todo = np.ones(len(sets), bool)
    while todo.any():  # breadth first
        queue = [int(np.argmax(todo))]
        todo[queue[0]] = False
        while queue:
            a = queue.pop()
            near = np.flatnonzero(linked[a] & todo)
            todo[near] = False
            for b in near.tolist():
                yield a, b
            queue.extend(near.tolist())


def _confirm(percent: int):
    def run(batches):
        a: list[int] = []
        b: list[int] = []
        for _, group in sorted_groups(batches, "pairs"):
            if group.num_rows > 1:
                node = group.column("node").to_pylist()
                sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
                for i, j in _links(sets, percent):
                    a.append(node[i])
                    b.append(node[j])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _with_centre(percent: int):
    """Links of nodes with the centre of their group; the centre comes first."""
    def run(batches):
        key = centre = own = None
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            cols = (batch.column(c).to_pylist() for c in ("pairs", "node", "shingles"))
            for pairs, node, raw in zip(*cols):
                mine = np.frombuffer(raw, np.uint64)
                if pairs != key:
                    key, centre, own = pairs, node, mine
                elif 100 * (both := len(np.intersect1d(own, mine, assume_unique=True))) >= percent * (len(own) + len(mine) - both):
                    a.append(centre)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def shared_buckets(signed: DataFrame) -> DataFrame:
    """(bucket, node, centre) of all buckets with two nodes or more, each row
    once; the centre is the smallest node."""
    member = signed.filter("node IS NOT NULL").select(F.explode("bands").alias("bucket"), "node") \
        .groupBy("bucket", "node").agg(F.lit(1).alias("one")).select("bucket", "node")
    centre = member.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last")).filter("centre < last")
    return member.join(centre, "bucket").select("bucket", "node", "centre")


def star_edges(member: DataFrame) -> DataFrame:
    """(a, b): every node b with the centre a of a bucket, each pair once."""
    return member.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()


def _packed_sets(texts: DataFrame, one: DataFrame, wanted: DataFrame) -> DataFrame:
    """(pairs, node, shingles): the set of every node of ``wanted`` (node,
    pairs array) under each of its pairs; ``one`` names a row for each node."""
    chosen = wanted.join(one, "node").select("rid", "node", "pairs")
    return texts.select("rid", "text").join(chosen, "rid").dropDuplicates(["node"]) \
        .mapInArrow(_pack, "node long, pairs array<long>, shingles binary") \
        .select("node", F.explode("pairs").alias("pairs"), "shingles")


def _first_links(texts: DataFrame, one: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Links of nodes with their smallest centre."""
    lowest = stored(stars.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("centre")), "lowest_centres")
    parts = stored(lowest.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")), "parts")
    member = lowest.join(parts, "centre").select("node", F.xxhash64("centre", F.pmod(F.hash("node"), F.col("parts"))).alias("pairs"))
    leading = parts.select(F.col("centre").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k")) \
        .select("node", F.xxhash64("node", "k").alias("pairs"))
    wanted = member.unionByName(leading).groupBy("node").agg(F.collect_set("pairs").alias("pairs"))
    # A centre is the smallest node of its group, so it sorts first.
    return _packed_sets(texts, one, wanted).repartition("pairs").sortWithinPartitions("pairs", "node") \
        .mapInArrow(_with_centre(percent), "a long, b long")


def _block_pairs(member: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, pairs array): the block pairs in which nodes of different
    classes that share a bucket meet."""
    named = stored(member.join(classes, "node", "left").select("bucket", "node", "centre", F.coalesce("component", "node").alias("class")),
                   "named_members")
    mixed = named.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("bucket")
    left = stored(named.join(stored(mixed, "mixed"), "bucket"), "mixed_members")
    loose = stored(connected_components(contracted(stored(star_edges(left), "stars"))), "loose")
    loose = loose.join(left.select("node", "class").distinct(), "node")
    share = loose.groupBy("component", "class").agg(F.count(F.lit(1)).alias("n"))
    size = share.groupBy("component").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.max("n").alias("n_main"),
                                          F.sum("n").alias("n"))
    size = stored(size.select("component", "main", F.ceil(F.col("n_main") / BLOCK).cast("int").alias("mains"),
                              F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int").alias("strays")), "loose_sizes")
    # Blocks of the largest class come after the others and don't meet each other.
    placed = loose.join(size, "component")
    is_main = F.col("class") == F.col("main")
    block = F.when(is_main, F.col("strays") + F.pmod(F.hash("node"), F.col("mains"))).otherwise(F.pmod(F.hash("node"), F.col("strays")))
    last = F.when(is_main, F.col("strays")).otherwise(F.col("strays") + F.col("mains")) - 1
    return placed.select("node", "component", block.alias("block"), F.explode(F.sequence(F.lit(0), last)).alias("other")) \
        .groupBy("node").agg(F.collect_set(F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other"))).alias("pairs"))


def contracted(stars: DataFrame) -> DataFrame:
    """Fewer edges with the same components: each node keeps the edge to its
    smallest centre, and its other centres are tied to that one. Nodes of a
    group share their centres, so those ties are few."""
    lowest = stars.groupBy("b").agg(F.min("a").alias("low"))
    ties = stars.join(lowest, "b").filter("a <> low").select(F.col("low").alias("a"), F.col("a").alias("b")).distinct()
    return lowest.select(F.col("low").alias("a"), "b").unionByName(ties)


def near_duplicates(docs: DataFrame, percent: int = 85, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z as a-z. Two texts
    are linked if 100 * intersection >= percent * union of their shingle
    sets (``rows``, a divisor of BINS, sets the recall as stated above);
    component_id is the smallest doc_id reachable, kept says whether it is
    the row's own. Null, empty and blank texts have an empty set and are
    linked with nothing. Repeated rows stay separate rows of one class. A
    null doc_id never becomes a component_id unless its class has no other;
    then component_id is null and the row is kept. Rows that share a doc_id
    but not a text are linked each by its own text. An empty table gives an
    empty result; other columns are ignored.
    """
    found = near_duplicate_rows(docs, percent, rows, id_col, text_col)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_duplicate_rows(docs: DataFrame, percent: int = 85, rows: int = ROWS, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """doc_id, rid, n_shingles, class, component_id: as ``near_duplicates``,
    with what tells rows apart (``row_key``) and the class, null for an empty
    set."""
    # Rows are told apart by id and text: ids may be shared or null.
    texts = keyed_texts(docs, id_col, text_col).withColumn("rid", row_key())
    signed = stored(texts.mapInArrow(_sign(rows), "doc_id long, rid long, node long, n_shingles long, bands array<long>"), "signed")
    member = stored(shared_buckets(signed), "buckets")
    one = stored(signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("rid").alias("rid")), "rows_of_nodes")
    first = stored(_first_links(texts, one, stored(star_edges(member), "stars"), percent), "links")
    # A block pair of a cluster is a group; small clusters have few.
    sets = _packed_sets(texts, one, _block_pairs(member, connected_components(first).select("node", "component")))
    links = stored(sets.repartition("pairs").sortWithinPartitions("pairs")
                   .mapInArrow(_confirm(percent), "a long, b long"), "links")
    classes = connected_components(first.unionByName(links))

    named = signed.select("doc_id", "rid", "node", "n_shingles")
    alone = named.filter("node IS NULL").select("doc_id", "rid", "n_shingles", F.col("node").alias("class"),
                                                F.col("doc_id").alias("component_id"))
    grouped = named.filter("node IS NOT NULL").join(classes, "node", "left") \
        .select("doc_id", "rid", "n_shingles", F.coalesce("component", "node").alias("class"))
    # Written, so that both sides of the join below are plain shuffles and a
    # class with a third of the rows can be split.
    lowest = stored(grouped.groupBy("class").agg(F.min("doc_id").alias("component_id")), "lowest")
    together = grouped.join(lowest, "class").select("doc_id", "rid", "n_shingles", "class", "component_id")
    return alone.unionByName(together)


def row_key() -> Column:
    """A hash of a row's doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
