"""Token counts by section: whole documents are encoded once, with the
character span of each token, and spans are joined to section intervals.

A token belongs to the section that holds most of its characters; of equal
shares the earliest section gets it. A token that touches no section is
counted under section -1. Sections don't overlap; they may leave gaps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bourse.llm.common import keyed_texts, steps
from bourse.llm.encode import KEPT_UNITS, encoder

SCHEMA = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long"
_SPANS: dict[str, dict[str, np.ndarray]] = {}


def line_sections(text: str) -> np.ndarray:
    """Start and end of every line (without its newline)."""
    lengths = np.array([len(x) for x in text.split("\n")])
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    return np.stack((starts, starts + lengths), axis=1)


def token_spans(text: str, path: str) -> np.ndarray:
    """Start and end of every token of a text, in code points."""
    known = _SPANS.setdefault(path, {})
    enc = encoder(path)
    if not enc.by_unit:
        found = enc.tokenizer.encode(text, add_special_tokens=False).offsets
        return np.array(found, np.int64).reshape(-1, 2)
    units = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
    parts = list(map(known.get, units))
    for k, part in enumerate(parts):
        if part is None:
            u = units[k]
            if u.isascii() and u.isalpha():  # bytes are characters
                found = [t.offsets for t in enc.model.tokenize(u.lower())]
            else:
                found = enc.tokenizer.encode(u, add_special_tokens=False).offsets if u else []
            parts[k] = np.array(found, np.int32).tobytes()
            if len(known) < KEPT_UNITS:
                known[u] = parts[k]
    sizes = np.array([len(p) for p in parts]) // 8
    lengths = np.array([len(u) for u in units])
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    spans = np.frombuffer(b"".join(parts), np.int32).reshape(-1, 2).astype(np.int64)
    return spans + np.repeat(starts, sizes)[:, None]


def attribute(spans: np.ndarray, sections: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of those also touch another
    section; the last entry of both counts tokens outside all sections."""
    n = len(sections)
    tokens, crossing = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    if len(spans):
        first = np.searchsorted(sections[:, 1], spans[:, 0], side="right")
        last = np.searchsorted(sections[:, 0], spans[:, 1], side="left") - 1
        home = np.where(first <= last, first, n)
        for k in np.flatnonzero(first < last).tolist():
            near = np.arange(first[k], last[k] + 1)
            held = np.minimum(sections[near, 1], spans[k, 1]) - np.maximum(sections[near, 0], spans[k, 0])
            home[k] = near[np.argmax(held)]
        tokens += np.bincount(home, minlength=n + 1)
        crossing += np.bincount(home[first < last], minlength=n + 1)
    return tokens, crossing


def _count(path: str, sections):
    def run(batches):
        for batch in steps(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = sections(text)
                tokens, crossing = attribute(token_spans(text, path), own)
                rows.append((doc, np.arange(len(own)), own[:, 0], own[:, 1], tokens[:-1], crossing[:-1]))
                if tokens[-1]:
                    rows.append((doc, [-1], [0], [len(text)], tokens[-1:], crossing[-1:]))
            counts = [len(r[1]) for r in rows]
            docs = np.repeat(np.arange(len(rows)), counts)
            ids = pa.array([r[0] for r in rows], pa.int64()).take(pa.array(docs))
            cols = [np.concatenate([r[k] for r in rows]).astype(np.int64) for k in range(1, 6)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cols[0], pa.int32(), safe=True), *[pa.array(c) for c in cols[1:]]],
                names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])
    return run


def section_token_counts(docs: DataFrame, tokenizer: str, sections=line_sections, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """doc_id, section, start, end, n_tokens, n_crossing: a row for every
    section of every row of ``docs`` (and one with section -1 if tokens lie
    outside all sections). ``sections`` gives a text's sections as an array
    of starts and ends in order, in code points.

    A null text is empty: it has one empty line. Repeated rows give repeated
    results, a null doc_id passes through, an empty table gives an empty
    result, other columns are ignored. Counts of a text's sections add up to
    the tokens of the whole text.
    """
    return keyed_texts(docs, id_col, text_col).mapInArrow(_count(tokenizer, sections), SCHEMA)
