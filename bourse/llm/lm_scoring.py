"""Language-model scoring: a log-bilinear neural model over word classes,
trained in numpy with noise-contrastive estimation.

Tokens are lower-case words and one end per text. Every word has a class:
the TOP most frequent words have one each, all others share TAILS classes by
their last two bytes, the end has its own. The model predicts the class of a
token from the classes of the two before it (a log-bilinear model: the
context vector is a sum of weighted embeddings, scores are its products with
target embeddings plus a bias). Within its class a word has its smoothed
share of the corpus counts, with one place left for unseen words, so
probabilities are normalised over an open vocabulary.

Corpus counts come from all training texts: texts are dealt into blocks by
id and text, each block sends one row per distinct word, and gets the counts
of its words back. The network is fitted on the counts of all class trigrams
(a class and the two before it) of all training texts: at most CLASSES**3
weighted rows, whatever the corpus size. Tasks hold at most HELD distinct
trigrams before they send them on; the counts meet in a groupBy.
Log-probabilities come from batched matrix products over the contexts that a
step of texts has.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import flat_bytes, keyed_texts, steps, stored, word_hashes

TOP = 192
TAILS = 63
CLASSES = TOP + TAILS + 1
END_CLASS = CLASSES - 1
# Bytes of text in a block, and in a numpy step.
BLOCK_BYTES = 16 << 20
STEP_BYTES = 1 << 19
# Distinct words or trigrams that a task merges at a time.
HELD = 1 << 19
FOLDS, HELD_OUT = 5, 1

DIM, NOISE, BATCH, EPOCHS, RATE = 32, 64, 1024, 3, 0.1
# A trigram's count is dealt to training rows of at most 1 / UNITS of all tokens each.
UNITS = 1 << 20
LN10 = float(np.log(10.0))


def is_held_out(doc_id: int | None) -> bool:
    """By the crc32 of the id as text; a null id is a training text's."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


# ---- words -------------------------------------------------------------------

def _words(column: pa.Array):
    """Signed hash, text number and tail class (0 to TAILS - 1) of every word."""
    h, owner, starts, ends, flat = word_hashes(column)
    last = flat[ends - 1].astype(np.int64)
    before = np.where(ends - 2 >= starts, flat[np.maximum(ends - 2, 0)].astype(np.int64), 0)
    last, before = (np.where((x >= 65) & (x <= 90), x + 32, x) for x in (last, before))
    return h.view(np.int64), owner, (last * 131 + before * 31) % TAILS


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """One row for each key of (keys, counts, ...): sorted keys, summed
    counts, and the first of the other values."""
    keys, first, inverse = np.unique(np.concatenate([x[0] for x in parts]), return_index=True, return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, inverse, np.concatenate([x[1] for x in parts]))
    return keys, counts, *(np.concatenate(rest)[first] for rest in zip(*(x[2:] for x in parts)))


def _count_words(batches):
    """For each block in the partition: distinct words with their count in
    training texts and whether a held-out text has them; the end is word 0
    with tail -1. Texts stream by; a block's distinct words are held."""
    for block, parts in itertools.groupby(_slices(batches), key=lambda x: x[0]):
        known, held = [], []
        ends = pending = 0
        for _, batch in parts:
            h, owner, tail = _words(batch.column("text"))
            out = np.array([is_held_out(d) for d in batch.column("doc_id").to_pylist()], bool)
            ends += int((~out).sum())
            own, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            known.append((own, np.bincount(inverse, weights=~out[owner], minlength=len(own)).astype(np.int64), tail[first]))
            held.append(own[np.bincount(inverse, weights=out[owner], minlength=len(own)) > 0])
            pending += len(own)
            if pending > HELD:
                known, held, pending = [_merged(known)], [np.unique(np.concatenate(held))], 0
        own, count, tail = _merged(known)
        out = np.isin(own, np.concatenate(held))
        if ends:
            own, count, out, tail = (np.append(a, v) for a, v in ((own, 0), (count, ends), (out, False), (tail, -1)))
        for lo in range(0, len(own), 50_000):
            cut = slice(lo, lo + 50_000)
            n = len(own[cut])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block, np.int32)), pa.array(own[cut]), pa.array(tail[cut].astype(np.int32)),
                 pa.array(count[cut]), pa.array(out[cut].astype(bool))], names=["block", "word", "tail", "n", "held"])


def _slices(batches):
    """(block, a step of its rows) of batches sorted by block."""
    for batch in steps(batches, limit=STEP_BYTES):
        block = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for lo, hi in zip(cuts, cuts[1:]):
            yield int(block[lo]), batch.slice(lo, hi - lo)


# ---- the network -------------------------------------------------------------

def _place(classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of ``rows`` by class."""
    one_hot = np.zeros((len(classes), CLASSES), np.float32)
    one_hot[np.arange(len(classes)), classes] = 1
    return one_hot.T @ rows.astype(np.float32)


def train(sequences: list[np.ndarray], seed: int = 7) -> dict[str, np.ndarray]:
    """Fit the model on class sequences (each ends with END_CLASS)."""
    padded = [np.concatenate(([END_CLASS, END_CLASS], s)).astype(np.int64) for s in sequences]
    keys = [(p[:-2] * CLASSES + p[1:-1]) * CLASSES + p[2:] for p in padded]
    return fit(*np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_counts=True), seed)


def fit(keys: np.ndarray, counts: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Fit the log-bilinear model on counts of class trigrams (keys: the
    class two before, the one before and the class, as digits to the base
    CLASSES) by noise-contrastive estimation with AdaGrad. A count becomes
    training rows that share its weight, so that a frequent trigram comes in
    many batches; up to UNITS tokens each has a row of its own. Noise classes
    are drawn from the smoothed class shares, NOISE for a batch."""
    rng = np.random.default_rng(seed)
    model = {"context": rng.normal(0, 0.1, (CLASSES, DIM)), "target": rng.normal(0, 0.1, (CLASSES, DIM)),
             "near": np.ones(DIM), "far": np.full(DIM, 0.5)}
    share = 1.0 + np.bincount(keys % CLASSES, weights=counts, minlength=CLASSES)
    share /= share.sum()
    model["bias"] = np.log(share)
    model = {k: v.astype(np.float32) for k, v in model.items()}
    if not len(keys):
        return model
    two, one, goal = (x.astype(np.uint8) for x in (keys // CLASSES**2, keys // CLASSES % CLASSES, keys % CLASSES))
    unit = max(1.0, counts.sum() / UNITS)
    rows = np.ceil(counts / unit).astype(np.int64)
    weight = (counts / (rows * unit)).astype(np.float32)
    order = np.repeat(np.arange(len(keys), dtype=np.int32), rows)
    log_noise = np.log(NOISE * share).astype(np.float32)
    size = {k: np.full_like(v, 1e-6) for k, v in model.items()}

    def step(name: str, grad: np.ndarray) -> None:
        size[name] += grad * grad
        model[name] -= RATE * grad / np.sqrt(size[name])

    for _ in range(EPOCHS):
        rng.shuffle(order)
        for lo in range(0, len(order), BATCH):
            k = order[lo:lo + BATCH]
            a, b, w = one[k], two[k], goal[k]
            noise = rng.choice(CLASSES, NOISE, p=share)
            ea, eb = model["context"][a], model["context"][b]
            vector = ea * model["near"] + eb * model["far"]
            tw, tn = model["target"][w], model["target"][noise]
            true = (vector * tw).sum(1) + model["bias"][w] - log_noise[w]
            false = vector @ tn.T + model["bias"][noise] - log_noise[noise]
            # Gradients of the logistic loss: true as data, noise as noise.
            gt = (-1 / (1 + np.exp(np.clip(true, -30, 30)))) * weight[k] / len(k)
            gf = (1 / (1 + np.exp(np.clip(-false, -30, 30)))) * weight[k][:, None] / len(k)
            gv = gt[:, None] * tw + gf @ tn
            grads = {
                "target": _place(w, gt[:, None] * vector) + _place(noise, gf.T @ vector),
                "bias": _place(w, gt) + _place(noise, gf.sum(0)),
                "context": _place(a, gv * model["near"]) + _place(b, gv * model["far"]),
            }
            grads["near"], grads["far"] = (gv * ea).sum(0), (gv * eb).sum(0)
            for name, grad in grads.items():
                step(name, grad)
    return model


def log_probabilities(model: dict[str, np.ndarray]) -> np.ndarray:
    """Normalised natural log-probability of every class after every pair of
    classes: [class before, the one before that, class]."""
    near = model["context"] * model["near"]
    far = model["context"] * model["far"]
    out = np.empty((CLASSES, CLASSES, CLASSES), np.float32)
    for a in range(CLASSES):  # a batch: all contexts with one nearest class
        scores = (near[a] + far) @ model["target"].T + model["bias"]
        top = scores.max(1, keepdims=True)
        out[a] = scores - top - np.log(np.exp(scores - top).sum(1, keepdims=True))
    return out


# ---- scoring -----------------------------------------------------------------

def token_log_probabilities(model: dict[str, np.ndarray], one: np.ndarray, two: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Natural log-probability of each token's class after the classes one
    and two before it: a row of products for each different context, by
    which its tokens are normalised."""
    contexts, which = np.unique(one * CLASSES + two, return_inverse=True)
    vector = (model["context"] * model["near"])[contexts // CLASSES] + (model["context"] * model["far"])[contexts % CLASSES]
    norm = np.empty(len(contexts), np.float64)
    for lo in range(0, len(contexts), 4_096):
        scores = vector[lo:lo + 4_096] @ model["target"].T + model["bias"]
        top = scores.max(1)
        norm[lo:lo + 4_096] = top + np.log(np.exp(scores - top[:, None]).sum(1))
    return np.einsum("ij,ij->i", vector[which], model["target"][classes]) + model["bias"][classes] - norm[which]


def _score(shared):
    def run(batches):
        s = shared.value
        top, tokens, distinct = s["top"], s["tokens"], s["distinct"]
        # Log share of a word with count c in its class; a class of its own has one word.
        class_tokens, class_words = s["class_tokens"], s["class_words"]
        rest = log_rest = None
        known, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        block = None
        base_rest = np.log10(tokens + 0.5 * (distinct + 1))
        log_rest = np.log(class_tokens + 0.5 * (class_words + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for lo, hi in zip(cuts, cuts[1:]):
                part = batch.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, known, counts, lists = blocks[lo], None, None, []
                kinds = part.column("kind").to_numpy()
                split = int(np.searchsorted(kinds, 1))  # word rows come before texts
                if split:
                    rows = part.slice(0, split)
                    lists.append((rows.column("key").to_numpy(), rows.column("n").to_numpy()))
                if split == part.num_rows:
                    continue
                if known is None:
                    known = np.concatenate([x for x, _ in lists]) if lists else np.zeros(0, np.int64)
                    counts = np.concatenate([x for _, x in lists]) if lists else np.zeros(0, np.int64)
                    by = np.argsort(known)
                    known, counts = known[by], counts[by]
                    lists = []
                for texts in steps([part.slice(split)], limit=STEP_BYTES):
                    yield _score_texts(texts, known, counts, s, top, base_rest, log_rest)
    return run


def _find(keys: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, keys), max(0, len(sorted_keys) - 1))
    return at, sorted_keys[at] == keys if len(sorted_keys) else np.zeros(len(keys), bool)


def _sequences(column: pa.Array, top: np.ndarray):
    """Hash and text number of every word; how many each text has; and, with
    each text's end after its words, the places of the words, and the classes
    of all tokens, of those before them and of those two before."""
    h, owner, tail = _words(column)
    n = len(column)
    order = np.argsort(top)
    place, is_top = _find(h, top[order])
    cls = np.where(is_top, order[place] if len(order) else 0, TOP + tail)
    per_text = np.bincount(owner, minlength=n)
    where = np.arange(len(h)) + owner
    starts = np.cumsum(per_text + 1) - 1 - per_text
    total = len(h) + n
    classes = np.full(total, END_CLASS, np.int64)
    classes[where] = cls
    one = np.empty(total, np.int64)
    one[1:], one[starts] = classes[:-1], END_CLASS
    two = np.full(total, END_CLASS, np.int64)
    two[2:] = classes[:-2]
    two[starts] = END_CLASS
    two[starts[per_text > 0] + 1] = END_CLASS
    return h, owner, per_text, where, classes, one, two


def _count_trigrams(shared):
    """Counts of the class trigrams of the partition's texts; a trigram may
    come more than once."""
    def run(batches):
        parts, pending = [], 0
        for batch in steps(batches, limit=STEP_BYTES):
            *_, classes, one, two = _sequences(batch.column("text"), shared.value)
            parts.append(np.unique((two * CLASSES + one) * CLASSES + classes, return_counts=True))
            pending += len(parts[-1][0])
            if pending > HELD:
                parts = [_merged(parts)]
                pending = 0
                if len(parts[0][0]) > HELD:
                    yield from _trigram_rows(*parts[0])
                    parts = []
        if parts:
            yield from _trigram_rows(*_merged(parts))
    return run


def _trigram_rows(keys: np.ndarray, counts: np.ndarray):
    for lo in range(0, len(keys), 50_000):
        cut = slice(lo, lo + 50_000)
        yield pa.RecordBatch.from_arrays([pa.array(keys[cut].astype(np.int32)), pa.array(counts[cut])], names=["key", "n"])


def _score_texts(batch, known, counts, s, top, base_rest, log_rest):
    ids = [None if z else d for d, z in zip(batch.column("key").to_pylist(), batch.column("null_id").to_pylist())]
    out = np.array([is_held_out(d) for d in ids], bool)
    h, owner, per_text, where, classes, one, two = _sequences(batch.column("text"), top)
    n = len(ids)
    at, found = _find(h, known)
    # Counts not sent: a training text's word is its own only one, a held-out text's is unknown.
    c = np.where(found, counts[at] if len(known) else 0, np.where(out[owner], 0, 1)).astype(np.int64)
    count = np.full(len(classes), s["ends"], np.int64)
    count[where] = c
    text = np.repeat(np.arange(n), per_text + 1)
    logp = token_log_probabilities(s["model"], one, two, classes)
    tails = (classes >= TOP) & (classes < END_CLASS)
    logp[tails] += np.log(count[tails] + 0.5) - log_rest[classes[tails]]
    base = np.log10(count + 0.5) - base_rest
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(out), pa.array(per_text + 1, pa.int64()),
         pa.array(np.bincount(text[count > 0], minlength=n), pa.int64()), pa.array(np.full(n, s["tokens"], np.int64)),
         pa.array(np.bincount(text, weights=base, minlength=n)),
         pa.array(np.bincount(text, weights=logp, minlength=n) / LN10)],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    for every row of ``docs``.

    held_out texts (crc32 of the id as text, modulo 5, is 1) are only
    scored; all others are counted. base_score is the add-half unigram
    score, score the model's log10 probability of the text. Words are told
    apart by 64-bit hashes. Null, empty and blank texts are one end token;
    repeated rows count and are scored as often as they stand; a null id
    counts as training; without training texts all counts are 0 and the
    model is untrained; an empty table gives an empty result; other columns
    are ignored.
    """
    spark = docs.sparkSession
    texts = keyed_texts(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")) if size > BLOCK_BYTES else 1)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    dealt = texts.withColumn("block", block)

    # One row for each block and distinct word; a word's rows, one a block, meet as sums.
    own = stored(dealt.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(
        _count_words, "block int, word long, tail int, n long, held boolean"), "block_words")
    totals = stored(own.groupBy("word", "tail").agg(F.sum("n").alias("total")), "word_counts")
    distinct = totals.filter("total > 0")
    sums = {r["tail"]: r for r in distinct.groupBy("tail").agg(F.sum("total").alias("n"), F.count("*").alias("v")).collect()}
    frequent = distinct.filter("tail >= 0").orderBy(F.desc("total"), "word").limit(TOP).collect()
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for tail, r in sums.items():
        if tail >= 0:
            class_tokens[TOP + tail], class_words[TOP + tail] = r["n"], r["v"]
    for r in frequent:  # they have left their tail classes
        class_tokens[TOP + r["tail"]] -= r["total"]
        class_words[TOP + r["tail"]] -= 1
    top = np.array([r["word"] for r in frequent], np.int64)

    training = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) != HELD_OUT
    trigrams = texts.filter(training).select("text").mapInArrow(
        _count_trigrams(spark.sparkContext.broadcast(top)), "key int, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    keys, counts = (trigrams.column(c).to_numpy().astype(np.int64) for c in ("key", "n"))
    by = np.argsort(keys)
    model = fit(keys[by], counts[by])
    state = {
        "model": model, "top": top,
        "class_tokens": class_tokens, "class_words": class_words,
        "tokens": int(sum(r["n"] for r in sums.values())), "distinct": int(sum(r["v"] for r in sums.values())),
        "ends": int(sums[-1]["n"]) if -1 in sums else 0}
    shared = spark.sparkContext.broadcast(state)

    # What a block can't know by itself: counts of 2 or more, and lone words that a held-out text may have.
    sent = own.join(totals, ["word", "tail"]).filter("tail >= 0 AND (total > 1 OR (total = 1 AND (held OR n = 0)))") \
        .select("block", F.lit(0).alias("kind"), F.col("word").alias("key"), F.lit(False).alias("null_id"),
                F.col("total").alias("n"), F.lit("").alias("text"))
    scored = dealt.select("block", F.lit(1).alias("kind"), F.coalesce("doc_id", F.lit(0)).alias("key"),
                          F.col("doc_id").isNull().alias("null_id"), F.lit(0).cast("long").alias("n"), "text")
    return sent.unionByName(scored).repartition(blocks, "block").sortWithinPartitions("block", "kind").mapInArrow(
        _score(shared), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                        "base_score double, score double")
