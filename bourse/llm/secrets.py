"""Secret scan: fixed patterns, and character Markov models of random strings
and of ordinary identifiers compared by their log-likelihood ratio.

Only DataFrame expressions run on the executors. One pass over the texts
finds the pattern matches and the long runs of key characters; the models
are then trained on labelled strings from that pass (matched values are
random, words of letters are ordinary), and a second pass over the small
table of runs keeps those that the random model explains better.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import keyed_texts, stored

# The base patterns, in the order of their kinds.
_VALUE = r"([A-Za-z0-9+/_.=-]+)"
_NAME = r"(?i:(password|passwd|secret|token|api_?key))"
ASSIGN = _NAME + r"""["']?\x20*[:=]\x20*["']?""" + _VALUE
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")

# Characters of keys; a run of RUN or more of them is put to the models.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
RUN = 20
_RUNS = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
_ORDINARY = r"(?<![A-Za-z0-9+/_-])[A-Za-z]{6,}(?![A-Za-z0-9+/_-])"
# Ordinary words come from about this many texts, chosen by hash (all, if fewer).
SAMPLE_TEXTS = 20_000
# Log-likelihood ratio (nats) from which a run counts as a secret.
RATIO = 12.0

# Characters of a piece of a text that is cut up.
BLOCK = 4096

_SPAN = "array<struct<start:long,kind:int,end:long>>"
_FOUND = "array<struct<start:long,end:long,found:string>>"


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or maxima, by ``join``) of an array of longs. Each step
    joins every entry with the one 1, 2, 4, ... before it, so n entries take
    n log n work; a fold that appends would copy n arrays."""
    steps = F.slice(F.sequence(F.lit(0), F.lit(30)), 1, F.when(F.size(values) > 1, F.ceil(F.log2(F.size(values)))).otherwise(0).cast("int"))

    def step(a: Column, k: Column) -> Column:
        before = lambda i: F.get(a, i - F.call_function("shiftleft", F.lit(1), k))
        return F.transform(a, lambda x, i: F.when(before(i).isNull(), x).otherwise(join(x, before(i))))

    return F.aggregate(steps, values, step)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _located(text: Column, pattern: str, gate: Column) -> Column:
    """Start, end and string of every match of ``pattern`` in order, in code
    points: running sums of the lengths of the matches and of the text
    between them. Empty without ``gate``, a cheap test that every match
    passes."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    lengths = F.zip_with(between, found, lambda b, m: (F.length(b) + F.length(m)).cast("long"))
    ends = _with(lengths, lambda x: _running(x, lambda p, q: p + q))
    spans = F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("found")))
    return F.when(gate, spans.cast(_FOUND)).otherwise(F.array().cast(_FOUND))


def _overlapped(runs: Column, base: Column) -> Column:
    """For each of ``runs`` (in order, apart from each other), how many of
    ``base`` overlap it: those that start before its end less those that end
    by its start. Both counts are running sums over sorted places."""
    def count(marks: Column, asked: Column, first: int) -> Column:
        # At equal places the questions come first if ``first`` is 0, else last.
        events = F.sort_array(F.concat(F.transform(marks, lambda m: F.struct(m.alias("at"), F.lit(1 - first).alias("asks"), F.lit(1).alias("n"))),
                                       F.transform(asked, lambda r: F.struct(r.alias("at"), F.lit(first).alias("asks"), F.lit(0).alias("n")))))
        return _with(events, lambda e: F.transform(
            F.filter(F.arrays_zip(e.alias("e"), _running(F.transform(e, lambda x: x["n"].cast("long")), lambda p, q: p + q).alias("c")),
                     lambda z: z["e"]["asks"] == first), lambda z: z["c"]))

    before = count(F.transform(base, lambda b: b["start"]), F.transform(runs, lambda r: r["end"]), 0)
    over = count(F.transform(base, lambda b: b["end"]), F.transform(runs, lambda r: r["start"]), 1)
    return F.zip_with(before, over, lambda x, y: x - y)


def _scan(texts: DataFrame, sampled: Column) -> DataFrame:
    """doc_id, matches of each kind, runs, and words of sampled texts."""
    t = F.col("text")
    named = t.rlike(_NAME + r"""["']?\x20*[:=]""")
    values = F.when(named, F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)))
    assign = _located(t, ASSIGN, named)
    first = texts.select(
        "doc_id",
        F.zip_with(assign, F.coalesce(values, F.array().cast("array<string>")),
                   lambda m, v: F.struct(m["start"].alias("start"), m["end"].alias("end"), v.alias("found"))).alias("assign"),
        _located(t, r"AKIA[A-Z0-9]{16,}", t.contains("AKIA")).alias("access"),
        _located(t, r"[0-9a-f]{24,}", t.rlike(r"[0-9a-f]{24}")).alias("hex"),
        _located(t, _RUNS, t.rlike(_RUNS)).alias("runs"),
        F.when(sampled, F.regexp_extract_all(t, F.lit(_ORDINARY), F.lit(0))).alias("words"))
    return first.withColumn("assign", F.filter("assign", lambda m: F.length(m["found"]) >= 6))


def _codes(s: Column) -> Column:
    return F.filter(F.transform(F.split(s, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1), lambda c: c >= 0)


def train(scanned: DataFrame) -> list[float]:
    """Log ratio of every pair of characters, random against ordinary, from
    counts of pairs in the labelled strings (one added to each count). At
    most 2 * 66 * 66 counts reach the driver."""
    k = len(ALPHABET)
    random = F.concat(*[F.transform(c, lambda m: m["found"]) for c in ("assign", "access", "hex")])
    labelled = scanned.select(F.explode(random).alias("s")).select(F.lit(1).alias("label"), "s") \
        .unionByName(scanned.select(F.explode("words").alias("s")).select(F.lit(0).alias("label"), "s"))
    codes = labelled.select("label", _codes(F.col("s")).alias("c")).filter(F.size("c") > 1)
    c = F.col("c")
    pairs = codes.select("label", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(c) - 1), lambda i: c[i - 1] * k + c[i])).alias("pair"))
    counts = [[1.0] * (k * k), [1.0] * (k * k)]
    for row in pairs.groupBy("label", "pair").count().collect():
        counts[row["label"]][row["pair"]] += row["count"]
    out = []
    for a in range(k):
        ordinary, rand = (math.fsum(t[a * k:(a + 1) * k]) for t in counts)
        out += [math.log(counts[1][p] / rand) - math.log(counts[0][p] / ordinary) for p in range(a * k, (a + 1) * k)]
    return out


def _ratio(s: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string: the sum over its pairs."""
    table = F.split(F.lit(",".join(f"{x:.3f}" for x in model)), ",").cast("array<double>")
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(_codes(s), start, lambda a, c: F.struct(
        c.alias("last"),
        F.when(a["last"] < 0, a["sum"]).otherwise(a["sum"] + F.get(table, a["last"] * len(ALPHABET) + c)).alias("sum")),
        lambda a: a["sum"])


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: float = RATIO) -> DataFrame:
    """doc_id, base and spans for every row of ``docs``: arrays of (start,
    kind, end) in code points, end exclusive, by start and then kind; kind
    is a place in KINDS. ``spans`` adds to ``base`` the runs that the random
    model explains better by ``ratio`` and that touch no base span.

    Null, empty and blank texts have no spans. Repeated rows give repeated
    results, a null doc_id passes through, an empty table gives an empty
    result, other columns are ignored. Without labelled strings both models
    are uniform and no run is added.
    """
    texts = keyed_texts(docs, id_col, text_col)
    share = min(1.0, SAMPLE_TEXTS / max(1, texts.count()))
    sampled = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < round(share * 1_000_000)
    scanned = stored(_scan(texts, sampled), "secret_scan")
    model = train(scanned)

    def spans(column: str, kind: int) -> Column:
        return F.transform(column, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"),
                                                      m["end"].alias("end"))).cast(_SPAN)

    base = scanned.select("doc_id", "runs", F.sort_array(F.concat(
        spans("assign", 0), spans("access", 1), spans("hex", 2))).alias("base"))
    runs = F.arrays_zip(F.col("runs").alias("run"), _overlapped(F.col("runs"), F.col("base")).alias("hits"))
    free = F.transform(F.filter(runs, lambda r: r["hits"] == 0), lambda r: r["run"])
    added = F.when(F.size("runs") > 0, F.filter(free, lambda r: _ratio(r["found"], model) >= ratio)).otherwise(F.col("runs"))
    both = base.withColumn("runs", added).select(
        "doc_id", "base", F.sort_array(F.concat("base", spans("runs", 3))).alias("spans"))
    # A generator of one row keeps filters on the spans from being computed below it again.
    return both.select("doc_id", F.inline(F.array(F.struct("base", "spans"))))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: float = RATIO) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov: the
    digest of ``secret_spans`` (spans as kind:start:end, joined by commas)."""
    found = secret_spans(docs, id_col, text_col, ratio)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"), count(3).alias("n_markov"))


def _blocks(text: Column) -> Column:
    """``text`` in pieces of BLOCK characters, by halving: finding a character
    by its number reads all before it, so it should not start at the text's."""
    halvings = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.length(text), F.lit(1)) / BLOCK))).cast("int")
    sizes = F.transform(F.slice(F.sequence(F.lit(1), F.lit(31)), 1, halvings),
                        lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), halvings - k) * BLOCK)

    def halve(a: Column, n: Column) -> Column:
        cut = F.transform(a, lambda x: F.when(F.length(x) > n, F.array(F.substring(x, F.lit(1), n.cast("int")),
                                                                       F.substring(x, (n + 1).cast("int"), n.cast("int")))).otherwise(F.array(x)))
        return F.flatten(cut)

    return F.aggregate(sizes, F.array(text), halve)


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span (sorted by start; they may overlap) replaced.
    Null and empty arrays leave it as it is."""
    def cut(blocks: Column, a: Column, b: Column) -> Column:
        """The characters from a to b, block by block."""
        parts = F.transform(F.sequence(F.floor(a / BLOCK), F.floor((b - 1) / BLOCK)), lambda k: F.substring(
            F.get(blocks, k.cast("int")), (F.greatest(a - k * BLOCK, F.lit(0)) + 1).cast("int"),
            (F.least(b - k * BLOCK, F.lit(BLOCK)) - F.greatest(a - k * BLOCK, F.lit(0))).cast("int")))
        return F.when(b > a, F.array_join(parts, "")).otherwise("")

    def build(blocks: Column) -> Column:
        reach = _with(F.transform(spans, lambda s: s["end"]), lambda e: _running(e, lambda p, q: F.greatest(p, q)))
        return _with(reach, lambda r: F.concat(
            F.array_join(F.transform(
                F.filter(F.transform(spans, lambda s, i: F.struct(
                    F.coalesce(F.get(r, i - 1), F.lit(0).cast("long")).alias("at"), s["start"].alias("start"))), lambda g: g["start"] >= g["at"]),
                lambda g: F.concat(cut(blocks, g["at"], g["start"]), F.lit(mark))), ""),
            cut(blocks, F.element_at(r, -1), F.length(text).cast("long"))))

    return F.when(F.size(spans) > 0, _with(_blocks(text), build)).otherwise(text)
