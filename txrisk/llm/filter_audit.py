"""What each filter of a chain removes, in every order (operator 11).

A row's failures are one bit per filter, its mask. Rows are counted per part and
mask, at most two to the number of filters cells a part, and everything after
that works on cells. A recursive query extends prefixes of filter orders by one
unused letter a level; it joins the part's cells, carries the bits applied so
far, and each level yields the figures of that step.

Whether a text repeats that of a smaller id is decided per digest: only the
smallest id of each digest is looked for again, by digest and id together, so a
group of copies of any size meets no join key of its own. Texts are read once
and never shuffled.

Defined results: a NULL text is empty, a NULL part is the empty string; a NULL
id is neither smaller nor larger than another, so its row repeats nothing;
repeated rows count as often as they occur; of several labels of one id, any that
says 1 counts; labels that are NULL or missing are 0; an empty table has no parts
and gives no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from math import factorial, perm

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.common import GAP, GAP_CHARS, body_text, stored

# Orders grow with the factorial: 7 filters have 5,040.
MOST_FILTERS = 7
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text decides by itself."""
    inner = F.btrim(text, F.lit(GAP_CHARS))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, f"{GAP}+")
    )
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def bits(filters: Mapping[str, Column]) -> Column:
    """One bit per failed filter; a condition that is NULL does not fail."""
    mask = F.lit(0)
    for place, condition in enumerate(filters.values()):
        mask = mask.bitwiseOR(F.when(condition, F.lit(1 << place)).otherwise(0))
    return mask


def documents_with_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents as (part, failures, good, toxic, n), n equal rows together.
    ``failures`` holds the bits of A to E."""
    text = body_text()
    rows = stored(
        docs.select(
            "doc_id",
            F.coalesce("lang", F.lit("")).alias("part"),
            bits(text_filters(text)).alias("failures"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "audited",
    )
    marks = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = firsts.withColumn("first", F.lit(True))
    # Equal rows are counted before they meet the joins.
    groups = rows.groupBy("doc_id", "digest", "part", "failures").agg(
        F.count(F.lit(1)).alias("n")
    )
    repeats = F.col("first").isNull() & F.col("doc_id").isNotNull()
    repeated = F.when(repeats, F.lit(1 << 4)).otherwise(0)
    return (
        groups.join(firsts, ["digest", "doc_id"], "left")
        .join(marks, "doc_id", "left")
        .select(
            "part",
            F.col("failures").bitwiseOR(repeated).alias("failures"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
            "n",
        )
    )


def mask_cells(rows: DataFrame, lost: Mapping[str, str]) -> DataFrame:
    """One row per part with its cells: mask, rows, and rows of each kind whose
    loss is to be reported."""
    kinds = [
        F.sum(F.when(F.expr(kind), F.col("n")).otherwise(0)).alias(name)
        for name, kind in lost.items()
    ]
    cells = rows.groupBy("part", "failures").agg(F.sum("n").alias("n"), *kinds)
    cell = F.struct(F.col("failures").alias("mask"), "n", *lost)
    return cells.groupBy("part").agg(F.collect_list(cell).alias("cells"))


@contextmanager
def _recursion_of(spark: SparkSession, rows: int):
    """Let a recursive query have as many rows as it is known to need."""
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, str(max(int(before), rows)) if int(before) >= 0 else before)
    try:
        yield
    finally:
        spark.conf.set(ROW_LIMIT, before)


STEPS = """
WITH RECURSIVE prefixes (part, prefix, applied, step, {columns}) AS (
    SELECT part, '', 0, 0, {zeros} FROM {{cells}}
    UNION ALL
    SELECT p.part, p.prefix || l.letter, p.applied | l.bit, p.step + 1, {figures}
    FROM prefixes p
    JOIN {{cells}} c ON c.part = p.part
    LATERAL VIEW explode(filter(array({letters}), l -> (p.applied & l.bit) = 0)) AS l
)
SELECT * FROM prefixes WHERE step > 0
"""


def step_figures(spark: SparkSession, cells: DataFrame, letters: str, lost: list[str]) -> DataFrame:
    """The figures of the last letter of every prefix of every order."""
    failed = "(x.mask & l.bit) <> 0"
    removed = f"{failed} AND (x.mask & p.applied) = 0"
    figures = {
        "kept": ("(x.mask & (p.applied | l.bit)) = 0", "n"),
        "removed": (removed, "n"),
        "redundant": (f"{failed} AND (x.mask & p.applied) <> 0", "n"),
        "unique_fails": ("x.mask = l.bit", "n"),
        **{name: (removed, name) for name in lost},
    }
    sums = [
        f"aggregate(c.cells, 0L, (a, x) -> a + if({condition}, x.{counted}, 0L)) AS {name}"
        for name, (condition, counted) in figures.items()
    ]
    bit_of = [f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters)]
    query = STEPS.format(
        columns=", ".join(figures),
        zeros=", ".join(["0L"] * len(figures)),
        figures=", ".join(sums),
        letters=", ".join(bit_of),
    )
    prefixes = sum(perm(len(letters), k) for k in range(len(letters) + 1))
    with _recursion_of(spark, prefixes * cells.count() + 1):
        return stored(spark.sql(query, cells=cells), "steps")


def filter_audit(rows: DataFrame, letters: str, lost: Mapping[str, str]) -> DataFrame:
    """Per part, order of ``letters`` and step, what the step's filter does.

    ``rows`` has part, failures (bit i for letter i), and n, the rows it stands
    for; ``lost`` names kinds of rows, given as SQL conditions, whose removals are
    counted as well.
    """
    if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"1 to {MOST_FILTERS} different letters, not {letters!r}")
    if not (letters.isascii() and letters.isalnum()):
        raise ValueError(f"letters or digits, not {letters!r}")
    spark = rows.sparkSession
    cells = stored(mask_cells(rows, lost), "cells")
    steps = step_figures(spark, cells, letters, list(lost))
    # A prefix stands for all orders that begin with it.
    orders_of = {k: factorial(len(letters) - k) for k in range(1, len(letters) + 1)}
    weights = F.create_map(*[F.lit(v) for pair in orders_of.items() for v in pair])
    weight = F.element_at(weights, F.col("step"))
    last = F.right("prefix", F.lit(1))
    shares = steps.groupBy("part", last.alias("letter")).agg(
        F.sum(F.col("removed") * weight).alias("shapley")
    )
    orders = steps.filter(F.col("step") == len(letters)).select(
        "part",
        F.col("prefix").alias("filter_order"),
        F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"),
    )
    orders = orders.withColumn("prefix", F.left("filter_order", F.col("step")))
    return (
        orders.join(steps.drop("step", "applied"), ["part", "prefix"])
        .withColumn("letter", last)
        .join(shares, ["part", "letter"])
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
            *lost, "shapley",
        )
    )
