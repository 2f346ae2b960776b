"""Quality rules: a threshold table compiled into one Spark projection.

Only DataFrame expressions: no Python runs on the executors, nothing is
shuffled, and each text is judged from its own row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORDY = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for on was be as with by this are from or at an not have "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "le la les de et des un une du que est en pour qui dans par sur au plus "
    "el los las y se por con para su al lo como más o pero una"
).split()


# The languages of those words, as the tables name them.
LANGUAGES = ("en", "de", "fr", "es")


@dataclass(frozen=True)
class Rule:
    """A ratio of two measures that must lie between ``least`` and ``most``.
    With ``languages`` it judges texts of these only; any other passes it."""

    name: str
    over: str
    under: str
    least: float | None = None
    most: float | None = None
    languages: tuple[str, ...] | None = None

    def passes(self) -> Column:
        # Compared as products, so that no division can fail.
        over, under = F.col(self.over), F.col(self.under)
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (over >= F.lit(self.least) * under)
        if self.most is not None:
            ok = ok & (over <= F.lit(self.most) * under)
        if self.languages is not None:
            ok = ok | ~F.coalesce(F.col("lang").isin(*self.languages), F.lit(False))
        return ok


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 15.0, LANGUAGES),
    Rule("symbol_ratio", "n_symbols", "n_words", most=0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", least=0.06, languages=LANGUAGES),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", most=0.4),
    Rule("duplicate_line_chars", "dup_line_chars", "line_chars", most=0.5),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", most=0.9),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", most=0.3),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


# Up to this many words, a window's hash and place share one long.
_PACKED_WORDS = 65_536


def _near(s: Column, x: Column, k: Column, same) -> Column:
    """Whether an entry of a sorted array equals its neighbour."""
    return ((k > 0) & same(F.get(s, k - 1), x)) | ((k + 1 < F.size(s)) & same(F.get(s, k + 1), x))


def _repeat_words(h: Column) -> Column:
    """Words covered by three-word windows found twice or more, from the
    64-bit hash of every window. Most texts repeat none, which a hash set
    shows; else sorting the hashes with their places puts equal ones side by
    side, so the work is that of a sort for any text. Up to 65,536 words the
    place replaces the hash's lowest digits (48 bits or more remain), which
    sorts as plain longs."""
    n = F.size(h).cast("long")

    def head(x: Column) -> Column:
        return F.shiftright(x, 16)

    packed = F.sort_array(F.transform(h, lambda x, i: F.shiftleft(F.shiftright(x, 16), 16).bitwiseOR(i.cast("long"))))
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def packed_places(s: Column) -> Column:
        return F.transform(F.filter(s, lambda x, k: _near(s, x, k, lambda a, b: head(a) == head(b))),
                           lambda x: x.bitwiseAND(F.lit(0xFFFF).cast("long")).cast("int"))

    def pair_places(s: Column) -> Column:
        return F.transform(F.filter(s, lambda x, k: _near(s, x, k, lambda a, b: a["h"] == b["h"])), lambda x: x["i"])

    places = F.sort_array(F.when(n <= _PACKED_WORDS, F.transform(F.array(packed), packed_places)[0])
                          .otherwise(F.transform(F.array(pairs), pair_places)[0]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        places, start,
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"])
    return F.when(F.size(F.array_distinct(h)) == n, F.lit(0).cast("long")).otherwise(covered)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, lang and every measure that the rules use. A null text is
    empty; without a column ``lang_col`` every text counts as one of
    LANGUAGES."""
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(LANGUAGES[0])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    trimmed = F.trim(text, F.lit(" \t\n\x0b\x0c\r"))
    parts = docs.select(
        F.col(id_col).alias("doc_id"), lang.alias("lang"), text.alias("t"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORDY)).alias("lines"))
    w = F.col("w")
    windows = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                                                 lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
    parts = parts.select("*", F.coalesce(windows, F.array().cast("array<long>")).alias("h"),
                         F.array_distinct("lines").alias("distinct"))
    lines, distinct = F.col("lines"), F.col("distinct")
    # A generator of one row: filters on the measures stay above it, where
    # they are computed once, and aren't copied into the steps below.
    return parts.select("doc_id", "lang", F.inline(F.array(F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(distinct)).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("h")).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.length(F.array_join(lines, "")).cast("long").alias("line_chars"),
        (F.length(F.array_join(lines, "")) - F.length(F.array_join(distinct, ""))).cast("long").alias("dup_line_chars"),
        F.size(F.filter(lines, lambda x: F.substring(F.ltrim(x), 1, 2).isin("- ", "* ", "• "))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(*sorted(set(STOP_WORDS))))).cast("long").alias("n_stop_words")))))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, then a boolean per rule, for every row of ``docs``.

    Null, empty and blank texts have no words and fail. Rules that know some
    languages only let texts of any other, or of none, pass. Repeated rows give
    repeated results; a null doc_id passes through; an empty table gives an
    empty result; other columns are ignored.
    """
    m = measures(docs, id_col, text_col, lang_col)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    kept = ~failed
    for rule in rules:
        kept = kept & rule.passes()
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), kept.alias("kept"),
                    *[rule.passes().alias(f"{rule.name}_ok") for rule in rules])
