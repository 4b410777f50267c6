"""Token counts through a digest cache (operator 13).

Texts are normalised to what the tokenizer sees and named by a digest; the
tokenizer is named by a digest of its file, the library and its version. Counts
are kept under both digests. A run joins its texts with the stored counts,
encodes each distinct text that has none, once, and appends those counts.

Only digests are joined with the cache; those of more than one in ``FREQUENT``
rows, which are at most that many, get their counts without a shuffle. Texts move
only on their way to the encoder, one row per distinct text and task, so a group
of copies of any size arrives as a few rows. Are the misses few, their digests filter the texts where
they are read; beyond ``FEW_MISSES`` the texts are brought together by digest
and those with a count dropped. Each run appends a folder of its own: a run that
fails leaves whole counts or none, and counts stored twice are equal.

Defined results: a NULL text is empty, with 0 bytes and what the tokenizer gives
for an empty text; texts of any length are encoded whole; a row is returned for
each row, NULL and repeated ids included; an empty table gives no rows and
appends nothing. Only ``doc_id`` and ``text`` are read, so other columns may
have any name, and they are not returned.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.common import stored

CACHE = "digest binary, n_tokens bigint, tokenizer string, run string"
# Digests broadcast at most, 32 bytes each.
FEW_MISSES = 100_000
# A digest that more than one in so many rows have is joined by broadcast.
FREQUENT = 1000
LIMIT = 4096


def tokenizer_file(path: str) -> tuple[str, bytes]:
    """The library that reads a tokenizer's file, and the file."""
    kind = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return kind, file.read()


def tokenizer_version(kind: str, content: bytes) -> str:
    """Digest of all that a count depends on besides the text."""
    used = [kind, importlib.metadata.version(kind), hashlib.sha256(content).hexdigest()]
    return hashlib.sha256(json.dumps(used).encode()).hexdigest()


def encoder(kind: str, content: bytes) -> Callable[[str], int]:
    """Number of tokens of a text, as the library gives them by itself."""
    if kind == "sentencepiece":
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_proto=content)
        return lambda text: len(pieces.encode(text, num_threads=1))

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def normalised(text: Column) -> Column:
    """The text as every tokenizer sees it. Tokenizers count case and white
    space, so nothing more can be folded without changing counts."""
    return F.coalesce(text, F.lit(""))


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Stored counts of a tokenizer's version; None where nothing was stored."""
    try:
        rows = spark.read.schema(CACHE).option("basePath", cache).parquet(
            f"{cache}/tokenizer={version}"
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def missing_digests(digests: DataFrame, known: DataFrame | None) -> DataFrame:
    wanted = digests.select("digest").distinct()
    return wanted if known is None else wanted.join(known, "digest", "left_anti")


def distinct_misses(
    texts: DataFrame, misses: DataFrame, known: DataFrame | None, few: int = FEW_MISSES
) -> DataFrame:
    """One row per distinct text (digest, text) without a stored count."""
    filtered = misses.count() <= few
    if filtered:
        texts = texts.join(F.broadcast(misses), "digest", "left_semi")
    once = texts.groupBy("digest").agg(F.any_value("text").alias("text"))
    if filtered or known is None:
        return once
    return once.join(known, "digest", "left_anti")


def append_counts(misses: DataFrame, cache: str, version: str, kind: str, content: bytes) -> None:
    """Encode the texts and store their counts."""
    spark = misses.sparkSession
    file = spark.sparkContext.broadcast(content)

    @F.pandas_udf("bigint")
    def n_tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = encoder(kind, file.value)
        for part in parts:
            yield part.map(count).astype("int64")

    rows = misses.select("digest", n_tokens("text").alias("n_tokens"))
    rows.write.parquet(f"{cache}/tokenizer={version}/run={uuid.uuid4().hex}")


def with_counts(rows: DataFrame, known: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The rows with ``n_tokens`` of their digest. Copies of one frequent text
    stay in the tasks that read them."""
    least = rows.count() / frequent
    often = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    often = stored(often.filter(F.col("copies") > least).select("digest"), "frequent-digests")
    few = known.join(F.broadcast(often), "digest", "left_semi")
    rest = rows.join(F.broadcast(often), "digest", "left_anti")
    return rest.join(known, "digest", "left").unionByName(rows.join(F.broadcast(few), "digest"))


def token_counts(
    docs: DataFrame, tokenizer: str, cache: str, limit: int = LIMIT, few: int = FEW_MISSES
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    ``tokenizer`` is a file that the driver can read; tasks get its content.
    ``cache`` is a folder that all executors share; it need not exist.
    """
    spark = docs.sparkSession
    kind, content = tokenizer_file(tokenizer)
    version = tokenizer_version(kind, content)
    text = normalised(F.col("text"))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")

    rows = stored(
        docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), digest),
        "digests",
    )
    known = cached_counts(spark, cache, version)
    misses = stored(missing_digests(rows, known), "missing-digests")
    if not misses.isEmpty():
        texts = docs.select(digest, text.alias("text"))
        append_counts(distinct_misses(texts, misses, known, few), cache, version, kind, content)
        known = cached_counts(spark, cache, version)
    elif known is None:
        known = spark.createDataFrame([], "digest binary, n_tokens bigint")
    return with_counts(rows, known).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
