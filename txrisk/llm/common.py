"""Column helpers and file helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.session import scratch_dir

# Characters between words: space and the five ASCII control spaces.
GAP = r"[\x20\x09-\x0D]"
GAP_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used.

    Projections alone do not promise that: the optimizer may copy an
    expression into a lambda, where it would run once per array element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def body_text(name: str = "text") -> Column:
    """The text, empty for NULL."""
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{GAP}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words. Where single spaces divide them, which a search tells,
    spaces are counted instead of splitting."""
    inner = F.btrim(text, F.lit(GAP_CHARS))
    spaces = F.length(inner) - F.length(F.replace(inner, F.lit(" "), F.lit("")))
    plain = ~inner.rlike(r"\x20\x20|[\x09-\x0D]")
    return (
        F.when(~has_word(text) | text.isNull(), F.lit(0))
        .when(plain, spaces + 1)
        .otherwise(F.size(F.split(inner, f"{GAP}+")))
    )


def has_word(text: Column) -> Column:
    """Whether a word is left of the text. Only the gap at its start is read."""
    return F.ltrim(text, F.lit(GAP_CHARS)) != ""


def set_aside(rows: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """The rows with those columns renamed whose names an operator needs for
    itself, and what each of them is called meanwhile."""
    needed = {name.lower() for name in names}
    clashing = [c for c in rows.columns if c.lower() in needed]
    meanwhile = {c: f"_own{k}_{c}" for k, c in enumerate(clashing)}
    return rows.withColumnsRenamed(meanwhile), meanwhile


def given_back(
    rows: DataFrame, columns: Iterable[str], meanwhile: dict[str, str], *more: str
) -> DataFrame:
    """The input's ``columns`` under their own names, and the output's ``more``,
    which win over input columns of the same name."""
    wins = {name.lower() for name in more}
    own = [F.col(f"`{meanwhile.get(c, c)}`").alias(c) for c in columns if c.lower() not in wins]
    return rows.select(*own, *more)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back: a lost
    executor costs no recomputation, and values such as generated ids are
    fixed from here on."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*spent: DataFrame) -> None:
    """Delete the folders of ``stored`` rows that nothing will read again: what
    was made of them must be stored itself."""
    for rows in spent:
        files = rows.inputFiles()
        if files:
            jvm = rows.sparkSession._jvm
            folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            settings = rows.sparkSession._jsc.hadoopConfiguration()
            folder.getFileSystem(settings).delete(folder, True)
