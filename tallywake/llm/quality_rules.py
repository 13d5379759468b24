"""Rules of thumb on a text's length, symbols, stop words and lines, as one projection.

`THRESHOLDS` is compiled into the projection: each row of the table names a measure, the least and the largest
value a text may have. There are no user functions and no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywake.llm.common import SPACE, unused

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "as", "be", "by", "are",
    "der", "die", "und", "das", "den", "von", "ist", "ein", "nicht", "mit", "zu",
    "le", "la", "les", "des", "et", "est", "que", "dans", "pour", "une", "qui",
    "el", "los", "las", "en", "y", "por", "con", "para", "del", "un", "de",
)


@dataclass(frozen=True)
class Rule:
    """A measure with its bounds; None leaves that side open."""

    measure: str
    least: float | None = None
    most: float | None = None


THRESHOLDS = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.25),
    Rule("stop_words_per_word", 0.02, None),
    Rule("dup_lines_per_line", None, 0.4),
    Rule("capital_words_per_word", None, 0.5),
    Rule("list_marks_per_word", None, 0.3),
)


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def measured(docs: DataFrame, text: str = "text", measures: str = "_q") -> DataFrame:
    """The columns of `docs` and a struct `measures` of counts and ratios of the text (null: no words). Repeated rows are
    alike, an empty table gives an empty one.

    Words are runs of other than ASCII white space, lines what \\n splits. n_repeat_words are the words in windows
    of three words found twice or more in the text. A ratio over no words or lines is null.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), body.alias("_t"), F.filter(
        F.split(body, SPACE), lambda w: w != "").alias("_w"), F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("_l"))
    # Windows by hash, then place; equal windows are neighbours, and a hash in common is checked word by word.
    n = F.size("_w")
    windows = F.when(n >= 3, F.transform(F.slice("_w", 1, F.greatest(n - 2, F.lit(0))), lambda w, i: F.struct(
        F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i"))))
    ordered = split.withColumn("_s", F.array_sort(windows))

    def same(a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (F.slice("_w", a["i"] + 1, 3) == F.slice("_w", b["i"] + 1, 3))

    twice = F.filter("_s", lambda s, k: F.coalesce(same(s, F.get("_s", k + 1)), F.lit(False)) | F.coalesce(
        (k > 0) & same(s, F.get("_s", F.greatest(k - 1, F.lit(0)))), F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2))))
    def long(c: Column) -> Column:
        return c.cast("bigint")

    counts = ordered.select("_row", F.struct(
        long(n).alias("n_words"),
        long(_without(F.col("_t"), SPACE)).alias("word_chars"),
        long(_without(F.col("_t"), "[^#*$%&|<>]")).alias("n_symbols"),
        long(F.size("_l")).alias("n_lines"),
        long(F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        long(F.coalesce(F.size(covered), F.lit(0))).alias("n_repeat_words"),
        long(F.size(F.filter("_w", lambda w: F.lower(w).isin(*STOP_WORDS)))).alias("n_stop_words"),
        long(F.size(F.filter("_w", lambda w: w.rlike(r"\p{Lu}") & ~w.rlike(r"\p{Ll}") & (F.length(w) > 1)))).alias("n_capital_words"),
        long(F.size(F.filter("_w", lambda w: w.isin("|", "-", "*", "#", "•")))).alias("n_list_marks"),
    ).alias("_q"))

    def ratio(part: str, whole: str) -> Column:
        return F.try_divide(F.col(f"_q.{part}").cast("double"), F.col(f"_q.{whole}").cast("double"))

    ratios = {
        "mean_word_chars": ratio("word_chars", "n_words"), "symbols_per_word": ratio("n_symbols", "n_words"),
        "stop_words_per_word": ratio("n_stop_words", "n_words"), "dup_lines_per_line": ratio("n_dup_lines", "n_lines"),
        "capital_words_per_word": ratio("n_capital_words", "n_words"), "list_marks_per_word": ratio("n_list_marks", "n_words"),
    }
    return counts.select("_row.*", F.struct("_q.*", *[v.alias(k) for k, v in ratios.items()]).alias(measures))


def broken(rules: tuple[Rule, ...], measures: str = "_q") -> Column:
    """The measures out of bounds, as an array of names; a null measure is never out of bounds."""
    def out(rule: Rule) -> Column:
        value = F.col(f"{measures}.{rule.measure}")
        sides = [value < rule.least] * (rule.least is not None) + [value > rule.most] * (rule.most is not None)
        return F.coalesce(sides[0] if len(sides) == 1 else sides[0] | sides[1], F.lit(False))
    return F.filter(F.array(*[F.when(out(r), F.lit(r.measure)) for r in rules]), lambda x: x.isNotNull())


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = THRESHOLDS, min_words: int = 50,
          most_repeated_percent: int = 50) -> DataFrame:
    """The columns of `docs`, `quality` (a struct of the measures), `broken` (measures out of bounds), `base_failed`
    (too short, or too much of it in repeated windows) and `kept`. Columns of these names are replaced."""
    q = unused("_q", docs.columns)
    found = measured(docs, text, q)
    short = F.col(f"{q}.n_words") < min_words
    repeats = 100 * F.col(f"{q}.n_repeat_words") > most_repeated_percent * F.col(f"{q}.n_words")
    own = ("quality", "broken", "base_failed", "kept")
    return found.select(
        *[F.col(c) for c in docs.columns if c not in own], F.col(q).alias("quality"), broken(rules, q).alias("broken"),
        (short | repeats).alias("base_failed"), (~(short | repeats) & (F.size(broken(rules, q)) == 0)).alias("kept"))
