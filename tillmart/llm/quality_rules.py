"""Quality rules (operator 2): a threshold table compiled into one projection.

A rule bounds `100 * numerator / denominator` of two counts of a document by
whole numbers from below and above. The table becomes one Boolean column of built-in
functions; no user function and no shuffle is involved. Counts:

n_words          words, runs of characters other than space and U+0009 to U+000D
word_chars       code points in words
n_symbols        characters of # * $ % & | < >
n_lines          lines with a word
n_dup_lines      lines with a word that equal an earlier line
n_repeat_words   words in 3-word windows found twice or more in the text
n_stop_words     words that are a stop word of any language of the table

Repeats are found by sorting the (hash, position) pairs of a text's windows, so a
text costs n log n however often it repeats itself.

Defined results: a null or empty text has zero everywhere and fails the base
rule; a rule whose denominator is zero passes; every row is judged alone, so repeated
rows and ids change nothing. Other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import word_array

SYMBOLS = "#*$%&|<>"

# Frequent function words, in their usual spelling within a sentence.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by are this at from an or not his but".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem eine ein nicht als auch es an".split(),
    "fr": "de la le et les des en un du une que pour est dans qui par au pas sur avec il elle ce se".split(),
    "es": "de la que el en y los se las del por un con no una su para al es lo como más o pero".split(),
}

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words",
)


@dataclass(frozen=True)
class Rule:
    """`low` <= 100 * `part` / `whole` <= `high`, in hundredths; None leaves a side open."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None

    def passes(self) -> Column:
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        out = F.lit(True)
        if self.low is not None:
            out = out & (part >= self.low * whole)
        if self.high is not None:
            out = out & (part <= self.high * whole)
        return out


RULES = (
    Rule("word length of 2 to 12", "word_chars", "n_words", 200, 1200),
    Rule("at most one symbol to ten words", "n_symbols", "n_words", None, 10),
    Rule("at least 6 in 100 words are stop words", "n_stop_words", "n_words", 6),
    Rule("at most 40 in 100 lines repeat", "n_dup_lines", "n_lines", None, 40),
    Rule("at least 2 words a line", "n_words", "n_lines", 200),
)
MIN_WORDS = 50
MAX_REPEAT = 50


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with the counts of the module's table in front of their own columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.struct("*").alias("row"), text.alias("text"), word_array(text_col).alias("words"))
    windows = F.when(
        F.size("words") >= 3,
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), _window),
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^ \t-\r]")))
    plain = F.col("text")
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    stop = sorted({w for words in STOP_WORDS.values() for w in words})
    counted = own.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.octet_length("text") - F.octet_length(plain)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        _repeated(F.sort_array(windows)).alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(stop))).cast("long").alias("n_stop_words"),
    )
    return counted.select(
        *(c for c in COUNTS if "line" not in c),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "row",
    )


def judge(
    docs: DataFrame,
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    min_words: int = MIN_WORDS,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """`row` (the input row), the counts, base_failed, failed (names of failed rules), kept."""
    base = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")
    )
    failed = [F.when(~rule.passes(), F.lit(rule.name)) for rule in rules]
    return text_counts(docs, text_col).select(
        "*",
        base.alias("base_failed"),
        F.array_compact(F.array(*failed)).alias("failed"),
        (~base & F.size(F.array_compact(F.array(*failed))).__eq__(0)).alias("kept"),
    )


def keep_good(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows that pass, with their own columns."""
    return judge(docs, text_col, **options).filter("kept").select("row.*")


def _window(start: Column) -> Column:
    words = [F.get("words", start + i) for i in range(3)]
    return F.struct(F.xxhash64(*words).alias("h"), start.alias("p"))


def _repeated(ordered: Column) -> Column:
    """Words under windows that have an equal neighbour in hash order."""

    def count(pairs: Column) -> Column:
        def twice(pair: Column, place: Column) -> Column:
            before, after = F.get(pairs, place - 1), F.get(pairs, place + 1)
            return F.coalesce(before["h"] == pair["h"], F.lit(False)) | F.coalesce(
                after["h"] == pair["h"], F.lit(False)
            )

        places = F.sort_array(F.transform(F.filter(pairs, twice), lambda pair: pair["p"]))
        none = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("total"))

        def add(state: Column, place: Column) -> Column:
            return F.struct(
                (place + 3).alias("upto"),
                (state["total"] + place + 3 - F.greatest(place, state["upto"])).alias("total"),
            )

        return F.aggregate(places, none, add, lambda state: state["total"]).cast("long")

    # A lambda's variable holds the sorted pairs, so that they are made once a text.
    return F.get(F.transform(F.array(ordered), count), F.lit(0))
