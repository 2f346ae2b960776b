"""Token ids of whole texts, made unit by unit.

The vocabulary that the queries use drops white space and never joins
characters across it, so a text's ids are those of its space-separated
units one after the other. Units repeat, so each process keeps the ids of
units it has seen (at most KEPT_UNITS, or as many as its user allows) and puts only new ones to the
tokenizers library: plain words in lower case to its BPE model, the signs that
follow a word and all other units to the whole tokenizer. A test holds the
result against whole-text encoding.

A vocabulary for which that doesn't hold for PROBES, or has no such model,
is used on whole texts.
"""

from __future__ import annotations

import re
from array import array

KEPT_UNITS = 1_100_000
# Runs of signs after a word whose ids a process keeps.
KEPT_RUNS = 10_000
# Texts that show whether units can be encoded by themselves (fixed values).
PROBES = ("a b", " the  cat's\t12 Dogs,\nall of them ", "Über größe, ÿ élan!", "x\ry <b> 漢字 z.", "don't stop? ümlaut: ",
          "word$$$ end.*** so,&&& é!? it'' a-_ (x) b<| c%%% d[{^~`")
# Letters that stay one piece under composition and lower-casing, then ASCII
# signs, which are a piece of their own.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


class _Units(dict):
    """Ids of units; those that aren't kept are made when asked for."""

    def __init__(self, make):
        super().__init__({"": b""})
        self.make = make

    def __missing__(self, unit: str) -> bytes:
        return self.make(unit)


class UnitEncoder:
    """Ids of texts as unsigned 32-bit integers, in bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}
        self.kept = KEPT_UNITS
        self.runs: dict[str, bytes] = {"": b""}
        self.forget()
        try:
            self.by_unit = all(b"".join(self.unit_ids(p)[1]) == self._whole(p) for p in PROBES)
        except Exception:  # a model that can't encode a single word
            self.by_unit = False

    def _whole(self, unit: str) -> bytes:
        return array("I", self.tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a plain lower-case word."""
        if not word.isascii():
            word = word.translate(self.bytes)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _run(self, run: str) -> bytes:
        """Ids of signs that follow a plain word."""
        ids = self.runs.get(run)
        if ids is None:
            ids = self._whole(run)
            if len(self.runs) < KEPT_RUNS:
                self.runs[run] = ids
        return ids

    def _make(self, unit: str) -> bytes:
        lower = unit.lower()
        plain = _PLAIN.fullmatch(lower) if len(lower) == len(unit) else None
        if plain is None:
            ids = self._whole(unit)
        else:
            word, run = plain.groups()
            ids = self._word(word) if word == unit else self.cache[word] + self._run(run)
        if len(self.cache) < self.kept:
            self.cache[unit] = ids
        return ids

    def forget(self) -> None:
        """Keep no unit's ids any longer."""
        self.cache = _Units(self._make)

    def unit_ids(self, text: str) -> tuple[list[str], list[bytes]]:
        """The units of a text (empty ones between two separators) and the
        ids of each."""
        units = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return units, list(map(self.cache.__getitem__, units))

    def encode(self, text: str) -> bytes:
        return b"".join(self.unit_ids(text)[1]) if self.by_unit else self._whole(text)


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str, kept: int | None = None) -> UnitEncoder:
    """This process's encoder for a vocabulary file, which keeps up to
    ``kept`` units (default KEPT_UNITS) from now on; of more, none stays."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    found = _ENCODERS[path]
    found.kept = KEPT_UNITS if kept is None else kept
    if len(found.cache) > found.kept:
        found.forget()
    return found
