"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.llm.text import SPACES, let

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?\"'()"
WINDOW = 5

# Frequent function words of the languages the corpus is written in.
STOP_WORDS = """a and are as at be by for from in is it of on or that the this to was with
der die das und den von zu mit ein eine ist für auf im nicht
le la les de des et en un une que qui dans pour par sur du
el los las que y del se por con para una su al""".split()


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high`` must hold for texts of at least ``min_words`` words."""

    name: str
    metric: str
    low: float = float("-inf")
    high: float = float("inf")
    min_words: int = 0


RULES = (
    Rule("mean_word_length", "chars_per_word", low=2.0, high=12.0),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("duplicate_lines", "dup_line_ratio", high=0.5),
    Rule("upper_case", "upper_per_char", high=0.4, min_words=20),
    Rule("stop_words", "stop_word_ratio", low=0.02, min_words=50),
)

# Each metric from the counted columns; the words are at least one where they apply.
METRICS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "upper_per_char": ("n_upper", "word_chars"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
}


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _long_size(items: Column) -> Column:
    return F.size(items).cast("long")


def _covered(hashes: Column) -> Column:
    """Words in windows that occur twice or more: sort the windows, keep those that equal
    a neighbour, and add up how far each reaches before the next one starts."""
    located = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def repeated(sorted_windows):
        def same(x, k):
            before, after = F.get(sorted_windows, k - 1), F.get(sorted_windows, k + 1)
            equal = F.coalesce(before["h"] == x["h"], F.lit(False))
            return equal | F.coalesce(after["h"] == x["h"], F.lit(False))

        kept = F.filter(sorted_windows, same)
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def reach(positions):
        steps = F.transform(
            positions,
            lambda p, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(positions, k + 1) - p, F.lit(WINDOW))
            ).cast("long"),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    return let(F.sort_array(located), lambda s: let(repeated(s), reach))


def _repeat_words(words: Column) -> Column:
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )
    counted = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(0),
    )
    return F.when(F.size(words) < WINDOW, 0).otherwise(counted).cast("long")


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with counts of words, characters, symbols, lines and repeated words.

    Windows of five words are compared by 64-bit hashes within one text. A null text
    counts as empty. Columns of the input with the names of the counts are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, WORD_BREAK), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "")
    bare = _without(whole, SPACES)
    stops = F.filter(
        F.col("_words"),
        lambda w: F.lower(F.rtrim(w, F.lit(PUNCTUATION))).isin(STOP_WORDS),
    )
    split = docs.withColumns({"_words": words, "_lines": lines, "_whole": whole})
    counted = split.withColumns(
        {
            "n_words": _long_size(F.col("_words")),
            "word_chars": F.length(bare).cast("long"),
            "n_symbols": (F.length(whole) - F.length(_without(whole, SYMBOLS))).cast("long"),
            "n_upper": F.length(F.regexp_replace(whole, r"\P{Lu}+", "")).cast("long"),
            "n_lines": _long_size(F.col("_lines")),
            "n_dup_lines": (
                F.size(F.col("_lines")) - F.size(F.array_distinct(F.col("_lines")))
            ).cast("long"),
            "n_stop_words": _long_size(stops),
            "n_repeat_words": let(F.col("_words"), _repeat_words),
        }
    )
    return counted.drop("_words", "_lines", "_whole")


def rule_holds(rule: Rule) -> Column:
    above, below = METRICS[rule.metric]
    ratio = F.col(above) / F.nullif(F.col(below), F.lit(0))
    inside = F.lit(True)
    if rule.low != float("-inf"):
        inside &= ratio >= rule.low
    if rule.high != float("inf"):
        inside &= ratio <= rule.high
    return F.when(F.col("n_words") < rule.min_words, True).otherwise(
        F.coalesce(inside, F.lit(True))
    )


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with counts, ``base_failed``, ``failed_rules`` and ``kept``.

    ``base_failed``: under ten words, or over a fifth of the words in repeated windows.
    An empty or null text fails. A repeated row is judged like any other. No shuffle.
    """
    failed = F.array_compact(
        F.array(*[F.when(~rule_holds(r), F.lit(r.name)) for r in rules])
    )
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    verdict = reduce(and_, [rule_holds(r) for r in rules], F.lit(True))
    judged = text_counts(docs, text).withColumns({"base_failed": base, "failed_rules": failed})
    return judged.withColumn("kept", ~F.col("base_failed") & verdict)
