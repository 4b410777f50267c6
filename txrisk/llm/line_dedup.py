"""Line deduplication with a suffix array over line ids (operator 10).

A document is the sequence of its lines that hold a word. Two equal runs of
consecutive lines with at least ``min_words`` words together are copies; the
first, in order of ``doc_id``, is kept, and all lines of later ones are deleted.

The suffixes of all sequences are sorted by prefix doubling: the rank of a
suffix by its first 2k lines is the order of the pair of ranks, by k lines, at
its place and k lines on. Suffixes of one rank are an interval of the suffix
array whose longest common prefix is at least that long. A rank that only one
suffix has ends that suffix's part: it shares no more with any other. Deciding
deletions needs the order only as deep as the shortest run of ``min_words``
words reaches, at most ``min_words`` lines, so the number of rounds does not
grow with the data. Lines that stand in one place only drop out before that.

No order of the intervals and no prefix lengths are written out: the ranks of
every length say which suffixes share an interval, and that is all deletions ask
for. A maximal repeated run is covered by its shortest runs of ``min_words`` words,
those that begin at a line and those that end at one. Each is looked up in the
interval of its length; where the interval's first member is an earlier place,
the run is a later copy. The union of such runs is the union of all maximal
repeated runs, and overlapping ones are joined before deletion.

Ranks are given to distinct pairs with more than one suffix, counted before the
shuffle, so a line or run that a third of all documents hold is one row; the
joins that bring ranks back are plain equalities that adaptive execution can
split. Windows run inside one document. Every round's ranks are written to the
shared folder, because the numbering must not change if a task is run again.

Defined results: a NULL text stays NULL and an empty one empty; rows without a
doc_id come last in order; of repeated rows one is the first and the others are
copies of it; an empty table gives an empty result; other columns pass through,
but for those named like a column of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import (
    body_text,
    discard,
    given_back,
    has_word,
    set_aside,
    stored,
    word_count,
)

MIN_WORDS = 50
ROW = "_row"


def _in_row(order: str) -> Window:
    return Window.partitionBy(ROW).orderBy(order)


def suffixes(rows: DataFrame) -> DataFrame:
    """One row per line with a word: ``pos`` among those of its document,
    ``line`` among all, ``at`` its place in the whole order, and two hashes
    that together identify the line."""
    numbered = F.filter(
        F.transform(F.split(body_text(), "\n"), lambda l, k: F.struct(l.alias("l"), k.alias("k"))),
        lambda x: has_word(x["l"]),
    )
    lines = rows.select("doc_id", ROW, F.posexplode(numbered).alias("pos", "x")).select(
        F.col("doc_id").isNull().alias("_none"),
        "doc_id",
        ROW,
        "pos",
        F.col("x.k").alias("line"),
        F.xxhash64("x.l").alias("h1"),
        F.xxhash64(F.lit("second"), "x.l").alias("h2"),
        word_count(F.col("x.l")).alias("n"),
    )
    order = ["_none", "doc_id", ROW, "pos"]
    # Stored first: sorting by range reads its input twice, and splitting texts
    # is the costly part.
    return stored(
        stored(lines, "lines")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.monotonically_increasing_id().alias("at"), ROW, "pos", "line", "h1", "h2", "n"),
        "suffixes",
    )


def ranked(pairs: DataFrame, label: str, *further: str) -> DataFrame:
    """Rank of each suffix by its pair of keys, for suffixes that share it.

    ``a``, ``b`` are the keys, ``further`` columns to keep. Distinct shared pairs
    are sorted over all partitions and numbered in order.
    """
    shared = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    numbered = stored(
        shared.repartitionByRange("a", "b")
        .sortWithinPartitions("a", "b")
        .select("a", "b", F.monotonically_increasing_id().alias("rank")),
        f"{label}-pairs",
    )
    return stored(pairs.join(numbered, ["a", "b"]).select(ROW, "pos", "at", "rank", *further), label)


def doubled(ranks: DataFrame, length: int) -> DataFrame:
    """Pairs of ranks for blocks of ``2 * length`` lines, from those of
    ``length``. Suffixes whose second half is unique or missing drop out."""
    ahead = _in_row("pos").rangeBetween(length, length)
    return (
        ranks.withColumn("b", F.max("rank").over(ahead))
        .filter(F.col("b").isNotNull())
        .select(ROW, "pos", "at", F.col("rank").alias("a"), "b")
    )


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs with ``min_words`` words: from each line on, and up to
    each line. ``lines`` are those that stand in several places; no run with
    another line has a copy, so each stretch of neighbours is looked at alone.
    ``pos`` and ``size`` place a run among the lines with a word, ``first`` and
    ``last`` among all lines."""
    stretch = (ROW, "_stretch")
    by_pos = Window.partitionBy(*stretch).orderBy("pos")
    before = F.sum("n").over(by_pos.rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        lines.withColumn("_stretch", F.col("pos") - F.row_number().over(_in_row("pos")))
        .withColumn("_before", F.coalesce(before, F.lit(0)))
        .withColumn("_upto", F.col("_before") + F.col("n"))
        .withColumn("_total", F.sum("n").over(Window.partitionBy(*stretch)))
        .filter(F.col("_total") >= min_words)
    )
    onward = Window.partitionBy(*stretch).orderBy("_before").rangeBetween(0, min_words - 1)
    back = Window.partitionBy(*stretch).orderBy("_upto").rangeBetween(-(min_words - 1), 0)
    seen = starts.select(
        ROW,
        "pos",
        "line",
        (F.col("_before") + min_words <= F.col("_total")).alias("_starts"),
        (F.col("_upto") >= min_words).alias("_ends"),
        F.count(F.lit(1)).over(onward).cast("int").alias("_on"),
        F.max("line").over(onward).alias("_last"),
        F.count(F.lit(1)).over(back).cast("int").alias("_back"),
        F.min("line").over(back).alias("_first"),
    )
    begins = F.struct(
        F.col("pos"), F.col("_on").alias("size"), F.col("line").alias("first"),
        F.col("_last").alias("last"),
    )
    ends = F.struct(
        (F.col("pos") - F.col("_back") + 1).alias("pos"), F.col("_back").alias("size"),
        F.col("_first").alias("first"), F.col("line").alias("last"),
    )
    runs = F.array(F.when(F.col("_starts"), begins), F.when(F.col("_ends"), ends))
    both = F.array_distinct(F.filter(runs, lambda r: r.isNotNull()))
    return seen.select(ROW, F.inline(both))


def later_copies(runs: DataFrame, ranks: DataFrame, length: int) -> DataFrame:
    """Runs of ``length`` to ``2 * length - 1`` lines that have an earlier copy.

    Such a run is two blocks of ``length`` lines, at its start and at its end,
    which may overlap; equal ranks of both mean equal runs.
    """
    mine = runs.filter(F.col("size").between(length, 2 * length - 1))
    heads = ranks.select(ROW, "pos", "at", F.col("rank").alias("a"))
    tails = ranks.select(ROW, F.col("pos").alias("_tail"), F.col("rank").alias("b"))
    placed = mine.withColumn("_tail", F.col("pos") + F.col("size") - length)
    placed = placed.join(heads, [ROW, "pos"]).join(tails, [ROW, "_tail"])
    firsts = (
        placed.groupBy("a", "b", "size")
        .agg(F.min("at").alias("_begin"), F.max("at").alias("_end"))
        .filter(F.col("_begin") < F.col("_end"))
        .drop("_end")
    )
    return (
        placed.join(firsts, ["a", "b", "size"])
        .filter(F.col("at") > F.col("_begin"))
        .select(ROW, "first", "last")
    )


def joined_runs(copies: DataFrame) -> DataFrame:
    """Overlapping or touching runs of a document as one, all of a document's in
    one sorted array ``deleted``."""
    so_far = _in_row("first").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("first") > F.max("last").over(so_far) + 1, F.lit(True))
    island = F.sum(F.col("_opens").cast("int")).over(
        _in_row("first").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        copies.distinct()
        .withColumn("_opens", opens)
        .withColumn("_island", island)
        .groupBy(ROW, "_island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .groupBy(ROW)
        .agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("deleted"))
    )


def repeated_runs(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row with later copies, the lines to delete as ``deleted``."""
    lines = suffixes(rows).withColumnsRenamed({"h1": "a", "h2": "b"})
    shared = ranked(lines, "ranks-1", "line", "n")
    runs = stored(shortest_runs(shared, min_words), "runs")
    longest = runs.agg(F.max("size")).first()[0] or 0
    ranks, length = shared.select(ROW, "pos", "at", "rank"), 1
    # Stored length by length: otherwise the plan grows with the rounds, and the
    # ranks of all of them are kept.
    copies = stored(later_copies(runs, ranks, 1), "copies-1")
    while 2 * length <= longest:
        spent, ranks = ranks, ranked(doubled(ranks, length), f"ranks-{2 * length}")
        length *= 2
        discard(spent)
        copies = copies.unionByName(stored(later_copies(runs, ranks, length), f"copies-{length}"))
    deleted = stored(joined_runs(copies), "deleted-runs")
    discard(runs, ranks)
    return deleted


def cut_lines(text: Column, deleted: Column) -> Column:
    """The text without the deleted runs of lines."""
    lines = F.split(text, "\n")
    begins = F.concat(F.array(F.lit(0)), F.transform(deleted, lambda r: r["last"] + 1))
    ends = F.concat(F.transform(deleted, lambda r: r["first"]), F.array(F.size(lines)))
    between = F.transform(
        F.arrays_zip(begins.alias("b"), ends.alias("e")),
        lambda x: F.slice(lines, x["b"] + 1, x["e"] - x["b"]),
    )
    return F.array_join(F.flatten(between), "\n")


RESULT = ("n_lines", "n_deleted", "deleted")


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, later copies of line runs deleted from ``text``, with
    ``n_lines`` and ``n_deleted`` (lines with a word) and ``deleted`` (first and
    last line of each deleted run, NULL if none)."""
    rows, meanwhile = set_aside(docs, (*RESULT, ROW))
    return given_back(_without_copies(rows, min_words), docs.columns, meanwhile, *RESULT)


def _without_copies(docs: DataFrame, min_words: int) -> DataFrame:
    rows = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "line-rows")
    deleted = repeated_runs(rows, min_words)
    matched = rows.join(deleted, ROW, "left")
    count = F.size(F.filter(F.split(body_text(), "\n"), has_word)).cast("bigint")
    some = F.col("deleted").isNotNull()
    cut = F.when(some, cut_lines(F.col("text"), F.col("deleted"))).otherwise(F.col("text"))
    return (
        matched.withColumn("n_lines", count)
        .withColumn("text", cut)
        .withColumn("n_deleted", F.when(some, F.col("n_lines") - count).otherwise(F.lit(0)))
        .drop(ROW)
    )


def kept_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents after deletion. One that lost all its lines is gone, as it was
    a copy throughout; ``n_chars``, where the input has it, follows the text."""
    rows, meanwhile = set_aside(docs, (*RESULT, ROW))
    rows = _without_copies(rows, min_words)
    rows = rows.filter((F.col("n_deleted") == 0) | (F.col("n_deleted") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = F.col("deleted").isNotNull()
        rows = rows.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return given_back(rows, docs.columns, meanwhile)
