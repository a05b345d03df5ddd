"""Quality rules: a threshold table compiled into one projection.

Every measure of a text is an expression over its words and lines; ``THRESHOLDS`` names measures
with the range that a good text has, and ``verdict`` compiles the table into one boolean. There
is no shuffle and no user function: each row is judged by itself, so no key can be hot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import NOT_SPACE, SPACES, lower_ascii

SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages.
STOP_WORDS = (
    "the be to of and that have with in is it for on as at by from this are was or an "
    "der die das und ist nicht ein eine zu den von mit sich des auf für im dem als auch "
    "le la les de des du et un une est que pour dans en qui sur pas au avec ce "
    "el los las y del que se por con una para es su al lo como más"
).split()


@dataclass(frozen=True)
class Threshold:
    """``measure`` must lie between ``least`` and ``most``."""

    measure: str
    least: float | None = None
    most: float | None = None


THRESHOLDS = (
    Threshold("mean_word_chars", 2, 15),
    Threshold("symbol_ratio", None, 0.1),
    Threshold("stop_ratio", 0.02, None),
    Threshold("dup_line_ratio", None, 0.5),
    Threshold("bang_ratio", None, 0.25),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeats(sorted_items: Column, key: Callable[[Column], Column]) -> Column:
    """The items of a sorted array whose key a neighbour has too."""

    def body(items: Column) -> Column:
        size = F.size(items)
        return F.filter(
            items,
            lambda x, i: ((i > 0) & (key(F.get(items, i - 1)) == key(x)))
            | ((i + 1 < size) & (key(F.get(items, i + 1)) == key(x))),
        )

    return let(sorted_items, body)


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words inside windows of ``width`` words that the text has more than once.

    Windows are sorted by a hash with the position in its low bits; those with equal hash bits
    are compared as text, so the count is exact.
    """

    def body(w: Column) -> Column:
        n = F.size(w)
        scale = F.greatest(n, F.lit(1)).cast("long")

        def window(i: Column) -> list[Column]:
            return [F.get(w, i + k) for k in range(width)]

        packed = F.transform(
            F.sequence(F.lit(0), n - width),
            lambda i: _packed(F.xxhash64(*window(i)), i, scale),
        )
        maybe = F.transform(
            _repeats(F.sort_array(packed), lambda x: x - F.pmod(x, scale)), lambda x: F.pmod(x, scale).cast("int")
        )
        exact = F.sort_array(F.transform(maybe, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("s"), i.alias("i"))))
        covered = F.flatten(
            F.transform(_repeats(exact, lambda x: x["s"]), lambda x: F.array(*[x["i"] + k for k in range(width)]))
        )
        return F.when(n >= width, F.size(F.array_distinct(covered))).otherwise(F.lit(0))

    return let(words, body)


def _packed(hash_: Column, i: Column, scale: Column) -> Column:
    """The hash, halved so that nothing overflows and rounded to ``scale``, plus the position."""
    half = F.shiftright(hash_, 1)
    return half - F.pmod(half, scale) + i


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row of ``docs`` (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words, lines, body = F.col("_words"), F.col("_lines"), F.col("_text")
    return (
        docs.select(F.col("doc_id").alias("doc_id"), text.alias("_text"))
        .select(
            "doc_id",
            "_text",
            F.regexp_extract_all("_text", F.lit(NOT_SPACE + "+"), 0).alias("_words"),
            F.filter(F.split("_text", "\n", -1), lambda s: s.rlike(NOT_SPACE)).alias("_lines"),
        )
        .select(
            "doc_id",
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.length(body) - F.length(F.translate(body, "!", ""))).cast("long").alias("n_bangs"),
            F.size(F.filter(F.split(lower_ascii(body), r"[\x20\x09-\x0D.,!?;:]+", -1), lambda x: x.isin(STOP_WORDS)))
            .cast("long")
            .alias("n_stop_words"),
        )
    )


def ratios() -> dict[str, Column]:
    """The measures that thresholds can name, over the columns of ``measured``."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "bang_ratio": F.col("n_bangs") / words,
        "stop_ratio": F.col("n_stop_words") / words,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_ratio": F.col("n_repeat_words") / words,
    }


def verdict(thresholds: Sequence[Threshold]) -> Column:
    """All thresholds as one boolean."""
    measures, good = ratios(), F.lit(True)
    for t in thresholds:
        if t.least is not None:
            good = good & (measures[t.measure] >= t.least)
        if t.most is not None:
            good = good & (measures[t.measure] <= t.most)
    return good


def judge(docs: DataFrame, thresholds: Sequence[Threshold] = THRESHOLDS) -> DataFrame:
    """The counts of every row of ``docs`` (doc_id, text), ``base_failed`` and ``kept``.

    ``base_failed``: under 50 words, or over half of them in repeated windows of three words.
    ``kept``: not base_failed and within all thresholds. Null and empty texts have no words and
    fail; of a very long text every word and line counts. Rows are judged one by one, so repeated rows
    and null ids give a row each; an empty table gives an empty result. Other columns are not read.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured(docs).select("*", failed.alias("base_failed"), (~failed & verdict(thresholds)).alias("kept"))
