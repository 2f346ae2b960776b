"""Repair of conversation structure by iterative-deepening A*.

A conversation's rows, taken in order, are edited until their roles follow
the pattern: perhaps a system turn first, then user and assistant in turn,
ending with the assistant (or nothing at all). Keep is free, Rerole (to user
or assistant) costs 1, Delete 2, Insert (an empty turn) 5; a truncated row
that stays costs 5 more, blank and repeated rows must go.

The search goes depth first over (row, state), trying edits in ASCII order
of their initials (D, I, K, R), under a bound on the total cost. The bound
starts at what the faults cost at least and rises to the least total that
passed it. A table keeps, for each state that failed, the least cost its
completion was proved to need, so a state is entered again only with more
left to spend. The first path accepted is thus the cheapest, and of equally
cheap ones the one whose initials come first.

Conversations are cut into segments of SEGMENT rows, so that a very long one
is searched by many tasks. For a segment that isn't its conversation's last,
the search first gives the cost from each state before it to each state
after it. Folded from the end, these costs tell what follows every segment;
with them as the price of each state after it, the search gives the edits
for each state before it, and a fold from the start picks among those. No
segment but the last inserts after its last row, so each edit sequence has
one way of being cut. What meets in one task for a conversation is 16
numbers a segment, and its rows streamed in order to the digest, never held.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import stored
from bourse.operators.ranks import places

SEGMENT = 256
# Faults, by rank.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
# What has been kept so far: nothing, a system turn, last a user's, last an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# Prices of the edits, and of a truncated row that stays (fixed values).
DELETE, INSERT, REROLE, STAYS_TRUNCATED = 2, 5, 1, 5
# What follows the last row: only the pattern's ends are free.
ACCEPT = [0, None, None, 0]
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")


# ---- search --------------------------------------------------------------------

def _kept(initial: str, state: int) -> int | None:
    """The state after a row that stays as it is, if it may."""
    if initial == "u" and state != USER:
        return USER
    if initial == "a" and state == USER:
        return ASSISTANT
    return SYSTEM if initial == "s" and state == START else None


def _moves(rows: list[tuple[str, int]], i: int, state: int, exits: list, open_end: bool):
    """(edit, new role, cost, next row, next state) in ASCII order of the
    edits; at the end of the rows the empty edit leaves."""
    role, after = ("a", ASSISTANT) if state == USER else ("u", USER)
    if i == len(rows):
        if exits[state] is not None:
            yield "", "", exits[state], i, state
        if open_end:
            yield "I", role, INSERT, i, after
        return
    initial, fault = rows[i]
    yield "D", "-", DELETE, i + 1, state
    yield "I", role, INSERT, i, after
    if fault not in (BLANK, DUPLICATE):
        extra = STAYS_TRUNCATED if fault == TRUNCATED else 0
        kept = _kept(initial, state)
        if kept is not None:
            yield "K", "-", extra, i + 1, kept
        if kept != after:
            yield "R", role, REROLE + extra, i + 1, after


def cheapest(rows: list[tuple[str, int]], entry: int = START, exits: list = ACCEPT, open_end: bool = True):
    """(cost, [(edit, new role)] for each row, state after) of the first of
    the cheapest edit sequences. ``rows`` are (role initial, fault), not
    empty; ``exits`` price the states after the last row (None: not allowed),
    one of which must be within reach. Edits after the last row are listed
    with it."""
    ahead = [min(x for x in exits if x is not None)]
    for _, fault in reversed(rows):  # each faulty row costs a deletion at least
        ahead.append(ahead[-1] + (DELETE if fault else 0))
    ahead.reverse()
    low: dict[tuple[int, int], int] = {}
    bound = ahead[0]
    while True:
        path = _descend(rows, entry, exits, open_end, ahead, low, bound)
        if path is not None:
            edits: list[list[tuple[str, str]]] = [[] for _ in rows]
            for edit, role, i in path[0]:
                edits[min(i, len(rows) - 1)].append((edit, role))
            return bound, edits, path[1]
        bound = low[0, entry]


def _descend(rows, entry, exits, open_end, ahead, low, bound):
    """The first path within ``bound`` and its last state, or None; then
    ``low`` holds what each failed state needs at least."""
    stack = [[0, entry, 0, _moves(rows, 0, entry, exits, open_end), float("inf")]]
    path: list[tuple[str, str, int]] = []
    while stack:
        frame = stack[-1]
        i, state, spent, moves, _ = frame
        for edit, role, cost, to, then in moves:
            needs = cost + (low.get((to, then), ahead[to]) if edit else 0)
            if spent + needs > bound:
                frame[4] = min(frame[4], needs)
            elif not edit:
                return path, state
            else:
                path.append((edit, role, i))
                stack.append([to, then, spent + cost, _moves(rows, to, then, exits, open_end), float("inf")])
                break
        else:
            low[i, state] = frame[4]
            stack.pop()
            if stack:
                path.pop()
                stack[-1][4] = min(stack[-1][4], spent - stack[-1][2] + low[i, state])
    return None


def _reached(rows: list[tuple[str, int]], entry: int, after: int) -> bool:
    """Whether edits that insert before rows only lead from entry to after."""
    if after == START:
        return entry == START
    if after == SYSTEM:
        return entry == SYSTEM or entry == START and any(x == "s" and f not in (BLANK, DUPLICATE) for x, f in rows)
    return True


# ---- segments ------------------------------------------------------------------

def _runs(batches, keys: list[str], values: list[str]):
    """(key, rows) of each run of equal keys in sorted batches."""
    key, held = None, []
    for batch in batches:
        ks = zip(*(batch.column(c).to_pylist() for c in keys))
        vs = zip(*(batch.column(c).to_pylist() for c in values))
        for k, v in zip(ks, vs):
            if k != key and held:
                yield key, held
                held = []
            key = k
            held.append(v)
    if held:
        yield key, held


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)] if rows
                                      else [pa.array([], f.type) for f in schema], schema=schema)


_CONV = [("conv", pa.int64()), ("null_conv", pa.bool_()), ("segment", pa.int64())]
_COSTS = pa.schema([*_CONV, ("entry", pa.int32()), ("after", pa.int32()), ("cost", pa.int64())])
_PATHS = pa.schema([*_COSTS, ("edits", pa.list_(pa.string())), ("roles", pa.list_(pa.string()))])
_REST = pa.schema([*_CONV, ("rest", pa.list_(pa.int64()))])
_ENTRY = pa.schema([*_CONV, ("entry", pa.int32())])
_KEY = "conv long, null_conv boolean, segment long"


def _entries(segment: int):
    return [START] if segment == 0 else STATES


def _segment_costs(batches):
    """Costs from each state before to each state after a segment."""
    for key, rows in _runs(batches, ["conv", "null_conv", "segment"], ["initial", "fault"]):
        out = []
        for entry in _entries(key[2]):
            for after in STATES:
                if _reached(rows, entry, after):
                    exits = [0 if s == after else None for s in STATES]
                    out.append((*key, entry, after, cheapest(rows, entry, exits, open_end=False)[0]))
        yield _batch(out, _COSTS)


def _segment_paths(batches):
    """Edits of a segment for each state before it, given the cheapest cost
    (``rest``) after each state behind it; none for a last segment."""
    out = []
    for key, rows in _runs(batches, ["conv", "null_conv", "segment"], ["initial", "fault", "rest"]):
        rest = rows[0][2]
        own = [r[:2] for r in rows]
        for entry in _entries(key[2]):
            cost, edits, after = cheapest(own, entry, rest or ACCEPT, open_end=rest is None)
            out.append((*key, entry, after, cost, ["".join(e for e, _ in x) for x in edits], ["".join(r for _, r in x) for x in edits]))
        if len(out) >= 1_000:
            yield _batch(out, _PATHS)
            out = []
    yield _batch(out, _PATHS)


def _fold_back(batches):
    """What follows each segment but the last, for every state behind it;
    rows of a conversation come with the last segment first."""
    for key, rows in _runs(batches, ["conv", "null_conv"], ["segment", "entry", "after", "cost"]):
        out, rest, at, segment = [], None, {}, None
        for seg, entry, after, cost in [*rows, (None, 0, 0, 0)]:
            if seg != segment:
                if segment is not None:
                    rest, at = [at.get(s) for s in STATES], {}
                if seg is not None and rest is not None:
                    out.append((*key, seg, rest))
                segment = seg
            if seg is not None:
                total = cost + (rest[after] if rest is not None else 0)
                at[entry] = min(total, at.get(entry, total))
        yield _batch(out, _REST)


def _fold_on(batches):
    """The state before each segment; rows come with the first segment first."""
    for key, rows in _runs(batches, ["conv", "null_conv"], ["segment", "entry", "after"]):
        out, state, done = [], START, -1
        for seg, entry, after in rows:
            if seg > done and entry == state:
                out.append((*key, seg, entry))
                state, done = after, seg
        yield _batch(out, _ENTRY)


def _sorted_by(df: DataFrame, keys: list[str], *more) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *more)


def edit_plan(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For rows (conv, null_conv, place, initial, fault): the edits of each
    row (conv, null_conv, place, edits, roles), and the cost of each
    conversation (conv, null_conv, cost)."""
    conv, segment = ["conv", "null_conv"], ["conv", "null_conv", "segment"]
    size = rows.groupBy(*conv).agg(F.floor((F.max("place") - 1) / SEGMENT).alias("final"))
    cut = stored(rows.select(*conv, F.floor((F.col("place") - 1) / SEGMENT).alias("segment"), "place", "initial", "fault")
                 .join(stored(size, "sizes"), conv), "segments")
    none = F.lit(None).cast("array<long>").alias("rest")
    ends = stored(_sorted_by(cut.filter("segment = final").select("*", none), segment, "place").mapInArrow(
        _segment_paths, f"{_KEY}, entry int, after int, cost long, edits array<string>, roles array<string>"), "paths")
    inner = cut.filter("segment < final")
    costs = _sorted_by(inner, segment, "place").mapInArrow(_segment_costs, f"{_KEY}, entry int, after int, cost long")
    steps = costs.unionByName(ends.filter("segment > 0").select(costs.columns))
    rest = _sorted_by(steps, conv, F.desc("segment")).mapInArrow(_fold_back, f"{_KEY}, rest array<long>")
    inner_paths = stored(_sorted_by(inner.join(rest, segment), segment, "place").mapInArrow(
        _segment_paths, f"{_KEY}, entry int, after int, cost long, edits array<string>, roles array<string>"), "paths")
    paths = ends.unionByName(inner_paths)
    entry = _sorted_by(paths.select(*segment, "entry", "after"), conv, "segment").mapInArrow(_fold_on, f"{_KEY}, entry int")
    chosen = stored(paths.join(entry, [*segment, "entry"]), "chosen")
    edits = chosen.select(*segment, F.posexplode(F.arrays_zip("edits", "roles")).alias("at", "edit")).select(
        *conv, (F.col("segment") * SEGMENT + F.col("at") + 1).alias("place"), "edit.edits", "edit.roles")
    return edits, chosen.filter("segment = 0").select(*conv, "cost")


# ---- rows ----------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with planted damage, by
    the crc32 of ``conv_id:turn`` modulo 20 (0 drops a row, 1 empties its
    text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's).
    Nulls become one space. Comes with the columns ``order_*`` that sort a
    conversation: rows of one turn number by role and text as they were."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(plain("conv_id"), F.lit(":"), plain("turn"))
    code = F.crc32(key.cast("binary")) % 20
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("was", "[.!?]", "")).otherwise(F.col("was"))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                plain("role").alias("order_role"), plain("text").alias("was"), code.alias("code")) \
        .filter("code <> 0").select(
            "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("order_role")).alias("role"), text.alias("text"),
            "order_role", F.substring("was", 1, 256).alias("order_text"), F.xxhash64("was").alias("order_hash"),
            F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("order_copy"))


def faulted(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows (conv_id, turn, role, text, no nulls in the last two) with their
    place in the conversation (turn, nulls first, then ``order``), role
    initial and first fault."""
    keyed = rows.withColumn("conv", F.coalesce("conv_id", F.lit(0))).withColumn("null_conv", F.col("conv_id").isNull())
    cols = ["conv", "null_conv", "place", "turn", "role", "text"]
    placed = places(keyed, [F.col("turn").asc_nulls_first(), *order], ["conv", "null_conv"]).select(*cols) \
        .withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    same = ["conv", "null_conv", "role", "digest"]
    # Written, so that a text that fills a conversation can be split in the join.
    first = stored(placed.groupBy(*same).agg(F.min("place").alias("first")), "first")
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("place") > F.col("first"), DUPLICATE) \
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(SOUND)
    return stored(placed.join(first, same).select(*cols, F.substring("role", 1, 1).alias("initial"), fault.alias("fault")), "faulted")


def repaired(edited: DataFrame) -> DataFrame:
    """The repaired conversations as rows (conv_id, place, step, role, text):
    ``place`` is that of the row it came from or was inserted beside, ``step``
    its number there."""
    op, role = F.substring("edits", F.col("step"), F.lit(1)), F.substring("roles", F.col("step"), F.lit(1))
    named = F.when(role == "u", ROLES["u"]).when(role == "a", ROLES["a"]).otherwise(F.col("role"))
    return edited.withColumn("step", F.explode(F.sequence(F.lit(1), F.length("edits")))).withColumn("op", op).filter("op <> 'D'") \
        .select("conv_id", "place", "step", named.alias("role"), F.when(F.col("op") == "I", "").otherwise(F.col("text")).alias("text"))


def _digests(batches):
    """Illegal neighbours, edits and SHA-256 of the repaired text of each
    conversation, from its rows in order; rows are not held."""
    schema = pa.schema([*_CONV[:2], ("illegal", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    key, before, illegal, audit, digest, lines = None, None, 0, [], hashlib.sha256(), 0
    for batch in batches:
        out = []
        cols = ["conv", "null_conv", "initial", "role", "text", "edits", "roles"]
        for conv, null, initial, role, text, edits, roles in zip(*(batch.column(c).to_pylist() for c in cols)):
            if (conv, null) != key:
                if key is not None:
                    out.append((*key, illegal, "".join(audit), digest.hexdigest()))
                key, before, illegal, audit, digest, lines = (conv, null), None, 0, [], hashlib.sha256(), 0
            illegal += before is not None and before + initial not in LEGAL
            before = initial
            audit.append(edits)
            for edit, new in zip(edits, roles):
                if edit != "D":
                    line = f"{ROLES.get(new, role)}:{'' if edit == 'I' else text}"
                    digest.update(("\n" * (lines > 0) + line).encode())
                    lines += 1
        yield _batch(out, schema)
    if key is not None:
        yield _batch([(*key, illegal, "".join(audit), digest.hexdigest())], schema)


def repair_conversations(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """The edited rows and a report for each conversation.

    Edited rows: conv_id, place, turn, role, text, initial, fault, edits (the
    row's edits, with those that insert before it, or after the last row),
    roles (the new role's initial for each edit, ``-`` where it keeps its
    own). ``repaired`` makes the new conversations of them. Report: conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A null conv_id is a conversation of its own. Rows of one turn number are
    taken by ``order``; repeated rows are duplicates, the first is not.
    An empty role has no initial and fits nowhere. An empty table gives empty
    results. Very long texts are hashed and matched whole, never held beside
    others.
    """
    marked = faulted(rows, order)
    edits, cost = edit_plan(marked)
    conv = ["conv", "null_conv"]
    own = F.when(~F.col("null_conv"), F.col("conv")).alias("conv_id")
    edited = stored(marked.join(edits, [*conv, "place"]), "edited")
    digests = _sorted_by(edited, conv, "place").mapInArrow(
        _digests, "conv long, null_conv boolean, illegal long, audit string, repaired_sha256 string")
    count = [F.count(F.when(F.col("fault") == f, 1)).alias(c) for f, c in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    report = marked.groupBy(*conv).agg(gaps, *count).join(cost, conv).join(digests, conv).select(
        own, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return edited.select(own, "place", "turn", "role", "text", "initial", "fault", "edits", "roles"), report


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The report on ``damaged`` conversations, with a row for every conv_id
    of the table: one whose rows were all dropped has zeros, an empty audit
    and the hash of the empty string."""
    order = [F.asc(c) for c in ("order_role", "order_text", "order_hash", "order_copy")]
    _, report = repair_conversations(damaged(conversations), order)
    every = conversations.select(F.col("conv_id").cast("long").alias("every")).distinct()
    zero, none = F.lit(0), hashlib.sha256(b"").hexdigest()
    return every.join(report, F.col("every").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("every").alias("conv_id"),
        *[F.coalesce(c, zero).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
