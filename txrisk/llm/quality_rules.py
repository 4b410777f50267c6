"""Quality rules with cross-document line frequency (operator 6).

Base rules look at one text: too few words, or too many words inside repeated
three-word windows. The method looks across documents: lines are normalised
and hashed, the distinct documents with a line are counted per host (the
``source``), lines above the limit are removed, and a document that loses most
of its words is rejected as depleted.

Copies of one document do not make its lines boilerplate: documents of a host
with the same text, known by its hash, count once. Where a line stands, and
next to which others, does not matter.

Only built-in functions are used. Holders are first reduced by host, line and
text, which spreads a line that a third of all documents hold over all tasks,
and then counted before the shuffle by line; the join that finds the lines to
remove is an inner join that adaptive execution can split.

Defined results: a NULL text is empty and a NULL source is the host ``""``;
repeated rows are documents of their own, whose equal results they share; an
empty table gives an empty result; other columns pass through, but for those
named like a column of the result, which is what is returned under that name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import (
    GAP_CHARS,
    bind,
    body_text,
    given_back,
    has_word,
    set_aside,
    word_count,
    words,
)


@dataclass(frozen=True)
class Limits:
    """A line is removed when more than ``host_share`` of its host's documents
    hold it. ``least`` only keeps one document, or a document and an edited
    copy, from making a line frequent where the share is less than that: more
    than ``least`` documents must hold it. A document is depleted when less than
    ``kept_share`` of its words remain."""

    host_share: float = 0.02
    least: int = 2
    kept_share: float = 0.2


SYMBOLS = "#*$%&|<>"
WINDOW = 3


def _repeats_before_or_after(items: Column, field: str) -> Column:
    """Items of a sorted array that equal a neighbour in ``field``."""
    return F.filter(
        items,
        lambda x, k: (x[field] == F.get(items, k - 1)[field])
        | (x[field] == F.get(items, k + 1)[field]),
    )


def repeated_words(ws: Column) -> Column:
    """Words inside three-word windows that the text has twice or more.

    Windows are compared by hash, and those whose hash repeats by their words.
    """
    starts = F.when(F.size(ws) >= WINDOW, F.sequence(F.lit(0), F.size(ws) - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )

    def hashed(i: Column) -> Column:
        return F.struct(
            F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i")
        )

    def spelled(x: Column) -> Column:
        i = x["i"]
        gram = F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))
        return F.struct(gram.alias("g"), i.alias("i"))

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    return bind(
        F.sort_array(F.transform(starts, hashed)),
        lambda sorted_: bind(
            F.sort_array(F.transform(_repeats_before_or_after(sorted_, "h"), spelled)),
            lambda grams: bind(
                F.sort_array(F.transform(_repeats_before_or_after(grams, "g"), lambda x: x["i"])),
                covered,
            ),
        ),
    )


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), has_word)


def base_counts(text: Column) -> Column:
    """The base figures of a text as one struct."""

    def figures(t: Column) -> Column:
        def of_words(ws: Column) -> Column:
            return bind(
                _lines(t),
                lambda ls: F.struct(
                    F.size(ws).cast("bigint").alias("n_words"),
                    F.length(F.translate(t, GAP_CHARS, "")).cast("bigint").alias("word_chars"),
                    (F.length(t) - F.length(F.translate(t, SYMBOLS, "")))
                    .cast("bigint")
                    .alias("n_symbols"),
                    (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint").alias("n_dup_lines"),
                    repeated_words(ws).cast("bigint").alias("n_repeat_words"),
                ),
            )

        return bind(words(t), of_words)

    return bind(text, figures)


def normal_line(line: Column) -> Column:
    """Lower case, single spaces, each run of digits as one zero."""
    spaced = F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))
    return F.regexp_replace(spaced, "[0-9]+", "0")


def line_hash(line: Column) -> Column:
    return F.xxhash64(normal_line(line))


def _row_key() -> list[Column]:
    return [F.col("doc_id").alias("_id"), F.xxhash64(body_text()).alias("_text")]


def document_lines(docs: DataFrame) -> DataFrame:
    """One row per document and distinct normalised line, with the words of the
    line where it first stands."""

    def first_of_each(items: Column) -> Column:
        return F.filter(
            items, lambda x, k: (k == 0) | (F.get(items, k - 1)["line"] != x["line"])
        )

    def located(ls: Column) -> Column:
        return bind(
            F.transform(ls, line_hash),
            lambda hs: bind(
                F.sort_array(
                    F.transform(
                        hs,
                        lambda h, k: F.struct(
                            h.alias("line"),
                            k.alias("k"),
                            word_count(F.get(ls, k)).alias("words"),
                        ),
                    )
                ),
                first_of_each,
            ),
        )

    lines = bind(_lines(body_text()), located)
    host = F.coalesce(F.col("source"), F.lit("")).alias("host")
    return docs.select(*_row_key(), host, F.explode(lines).alias("at")).select(
        "_id", "_text", "host", "at.line", "at.words"
    )


def frequent_lines(docs: DataFrame, limits: Limits) -> DataFrame:
    """Lines above the limit of their host."""
    hosts = docs.groupBy(F.coalesce(F.col("source"), F.lit("")).alias("host")).agg(
        F.count(F.lit(1)).alias("documents")
    )
    held = (
        document_lines(docs)
        .groupBy("host", "line", "_text")
        .agg(F.lit(1))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("holders"))
        .filter(F.col("holders") > limits.least)
    )
    above = F.col("holders") > limits.host_share * F.col("documents")
    return held.join(hosts, "host").filter(above).select("host", "line")


RESULT = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words",
    "removed_lines", "base_failed", "kept",
)
HELPERS = ("_id", "_text", "_of_id", "_of_text", "_base")


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Documents with the base figures, ``base_failed``, ``removed_lines`` (hashes
    of the lines to remove, NULL if none), ``removed_words`` and ``kept``."""
    rows, meanwhile = set_aside(docs, (*RESULT, *HELPERS))
    return given_back(_judged(rows, limits), docs.columns, meanwhile, *RESULT)


def _judged(docs: DataFrame, limits: Limits) -> DataFrame:
    removed = (
        document_lines(docs)
        .join(frequent_lines(docs, limits), ["host", "line"])
        .groupBy("_id", "_text", "line")
        .agg(F.max("words").alias("words"))
        .groupBy("_id", "_text")
        .agg(
            F.sum("words").alias("removed_words"),
            F.collect_list("line").alias("removed_lines"),
        )
        .withColumnsRenamed({"_id": "_of_id", "_text": "_of_text"})
    )
    judged = docs.select("*", base_counts(body_text()).alias("_base"), *_row_key()).select(
        *docs.columns, "_id", "_text", F.inline(F.array("_base"))
    )
    matched = judged.join(
        removed,
        judged["_id"].eqNullSafe(removed["_of_id"]) & (judged["_text"] == removed["_of_text"]),
        "left",
    ).drop("_id", "_text", "_of_id", "_of_text")
    n, removed_words = F.col("n_words"), F.coalesce("removed_words", F.lit(0))
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    depleted = (n - removed_words) < limits.kept_share * n
    return matched.withColumns(
        {"removed_words": removed_words, "base_failed": failed, "kept": ~failed & ~depleted}
    )


def without_removed_lines(text: Column, removed: Column) -> Column:
    """The text without the lines whose hash is among ``removed``."""
    rest = F.filter(
        F.split(text, "\n"), lambda l: ~(has_word(l) & F.array_contains(removed, line_hash(l)))
    )
    return F.when(F.size(removed) > 0, F.array_join(rest, "\n")).otherwise(text)


def kept_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Kept documents, their lines above the limits removed. ``n_chars``, where
    the input has it, follows the new text."""
    rows, meanwhile = set_aside(docs, (*RESULT, *HELPERS))
    rows = _judged(rows, limits).filter("kept")
    cut = F.col("removed_words") > 0
    text = F.when(cut, without_removed_lines(F.col("text"), F.col("removed_lines"))).otherwise(
        F.col("text")
    )
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(cut, length).otherwise(F.col("n_chars")))
    return given_back(rows, docs.columns, meanwhile)
