"""Groups of words that differ by single edits (operator 12).

Two words differ by exactly one inserted, deleted or replaced code point if
their common prefix and common suffix together reach the longer length less
one. To be compared, words must share a block: the edit stands in one of the
word's stretches of ``step`` code points, and a block holds the words that agree
before and after one stretch. So no near pair is missed, and a block's size is
bounded by what fits into a stretch, not by the number of words. Larger blocks
are cut into tiles, and each pair of tiles is a unit of work of its own.

Units come to the tasks sorted, and a slice of many units is compared at once:
its words as two padded matrices of code points, aligned at the start and at the
end, of which rows of the same unit are compared at growing distance. Of the
blocks that a pair shares, only the first yields it.

Words are counted per task before they are shuffled. Forms are followed to the
last by pointer doubling: a form occurs at least ``ratio`` times as often as its
word, so chains are short.

Defined results: a NULL text has no words; a NULL id is the empty string where
occurrences are hashed; rows repeated with the same id count again; an empty
table, or one without a frequent word, gives no rows. Only ``doc_id`` and
``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import stored

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_TIMES = 3
# One in so many hashes deletes a code point of its run.
DAMAGE = 97
RATIO = 2
# Words a task counts before it hands the counts on.
HELD_WORDS = 300_000
# Texts above this many bytes are searched run by run instead of at once.
LONG_TEXT = 1_000_000
# Code points of a stretch, and how many stretches a long word has at most.
STEP = 3
MOST_STRETCHES = 8
# Words of a tile, and code points of a comparison.
TILE = 1024
CELLS = 2_000_000


def damaged(run: str, id_hash: int) -> str:
    """The run, less one code point if the hash of id and run says so."""
    h = zlib.crc32(run.encode(), id_hash)
    if h % DAMAGE:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def text_words(doc_id: str, text: str) -> Counter[str]:
    """Words of a text, long enough ones only."""
    # Bytes fold the case of A to Z alone.
    folded = text.encode("utf-8", "replace").lower().decode()
    short = len(folded) <= LONG_TEXT
    runs = re.findall(RUN, folded) if short else (m[0] for m in re.finditer(RUN, folded))
    id_hash = zlib.crc32(f"{doc_id}:".encode())
    found: Counter[str] = Counter()
    for run, times in Counter(runs).items():
        if len(run) >= LEAST_LENGTH:
            word = damaged(run, id_hash)
            if len(word) >= LEAST_LENGTH:
                found[word] += times
    return found


def _counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            for word, times in text_words(doc_id, text).items():
                held[word] += times
            if len(held) > HELD_WORDS:
                yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
                held = Counter()
    if held:
        yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})


def word_counts(docs: DataFrame, least: int = LEAST_TIMES) -> DataFrame:
    """Words that occur at least ``least`` times, with their number ``n``."""
    rows = docs.filter("text IS NOT NULL").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text"
    )
    counted = rows.mapInPandas(_counted, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def stretch(longer: Column) -> Column:
    """Code points of a stretch in a pair whose longer word has ``longer``."""
    return F.greatest(F.lit(STEP), F.ceil(longer / MOST_STRETCHES).cast("int"))


def block_entries(words: DataFrame) -> DataFrame:
    """Every word in all its blocks: for pairs in which it is the longer word or
    as long (``longer`` is its length) and the shorter (one more), and for each
    place ``at`` where a stretch may begin."""
    length = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("longer"))
    rows = rows.withColumn("step", stretch(F.col("longer")))
    rows = rows.withColumn("at", F.explode(F.expr("sequence(0, longer - 1, step)")))
    rest = F.greatest(F.lit(0), F.col("longer") - F.col("at") - F.col("step"))
    block = F.xxhash64("longer", "at", F.left("word", F.col("at")), F.right("word", rest))
    return rows.withColumn("block", block)


def units(entries: DataFrame, tile: int = TILE, cells: int = CELLS) -> DataFrame:
    """Entries in their units: the whole block, or a pair of its tiles (``lo``,
    ``hi``). Words that are alone in a block are left out."""
    sizes = entries.groupBy("block").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    rows = F.greatest(F.lit(2), F.least(F.lit(tile), F.lit(cells) / F.col("longer"))).cast("int")
    rows = entries.join(sizes, "block").withColumn("tiles", F.ceil(F.col("size") / rows))
    rows = rows.withColumn("tile", F.expr("pmod(xxhash64(word, block), tiles)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    return rows.select(
        "longer", "block", F.least("tile", "other").alias("lo"),
        F.greatest("tile", "other").alias("hi"), "tile", "at", "step", "word", "n",
    )


UNIT = ["longer", "block", "lo", "hi"]
PAIR = "word string, near string, near_n bigint"


def code_points(words: list[str], width: int) -> np.ndarray:
    """Words as rows of code points, filled up with zeros."""
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def common(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Code points that rows a and b share from the start on. Rows differ."""
    return np.argmin(points[a] == points[b], axis=1)


def unit_ends(slice_: pd.DataFrame) -> np.ndarray:
    """For each row of sorted units, the row after its unit's last."""
    keys = slice_[UNIT].to_numpy()
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    return np.repeat(np.r_[starts[1:], len(keys)], np.diff(np.r_[starts, len(keys)]))


def compare(slice_: pd.DataFrame, cells: int = CELLS) -> Iterator[pd.DataFrame]:
    """Near pairs of whole units, each pair once in either direction."""
    words = slice_["word"].tolist()
    length, n = slice_["word"].str.len().to_numpy(), slice_["n"].to_numpy()
    longer, at, step = (slice_[c].to_numpy() for c in ("longer", "at", "step"))
    tile = slice_["tile"].to_numpy()
    across = (slice_["lo"] != slice_["hi"]).to_numpy()
    width = max(1, int(length.max()))
    front, back = code_points(words, width), code_points([w[::-1] for w in words], width)
    after = unit_ends(slice_) - np.arange(len(words))
    names = np.array(words, dtype=object)
    rows, distance = np.arange(len(words)), 1
    while len(rows := rows[after[rows] > distance]):
        for part in np.array_split(rows, max(1, -(-len(rows) * width // cells))):
            a, b = part, part + distance
            # Of two tiles only pairs across them; hashes may mix two blocks.
            meet = (~across[a] | (tile[a] != tile[b])) & (at[a] == at[b])
            meet &= np.maximum(length[a], length[b]) == longer[a]
            a, b = a[meet], b[meet]
            ahead, behind = common(front, a, b), common(back, a, b)
            first = np.maximum(0, longer[a] - 1 - behind) // step[a] * step[a]
            near = (ahead + behind >= longer[a] - 1) & (first == at[a])
            if near.any():
                a, b = np.r_[a[near], b[near]], np.r_[b[near], a[near]]
                yield pd.DataFrame({"word": names[a], "near": names[b], "near_n": n[b]})
        distance += 1


def _near_pairs(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Compare slices of whole units; a batch's last unit waits for the next."""
    held: pd.DataFrame | None = None
    for batch in batches:
        if batch.empty:
            continue
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        ends = unit_ends(batch)
        last = int(np.searchsorted(ends, ends[-1]))
        yield from _slices(batch.iloc[:last], ends[:last])
        held = batch.iloc[last:].reset_index(drop=True)
    if held is not None:
        yield from compare(held)


def _slices(rows: pd.DataFrame, ends: np.ndarray) -> Iterator[pd.DataFrame]:
    """Whole units of at most ``CELLS`` code points together, or one unit."""
    longer, begin = rows["longer"].to_numpy(), 0
    stops = np.unique(ends)
    for k, stop in enumerate(stops):
        following = stops[k + 1] if k + 1 < len(stops) else None
        # Units are sorted by length, so the last one's rows are the widest.
        if following is None or (following - begin) * longer[following - 1] > CELLS:
            yield from compare(rows.iloc[begin:stop].reset_index(drop=True))
            begin = stop


def near_words(words: DataFrame) -> DataFrame:
    """Pairs (word, near, near_n) of words one edit apart, in both directions."""
    rows = units(block_entries(words))
    rows = rows.repartition("block", "lo", "hi").sortWithinPartitions(*UNIT)
    return rows.mapInPandas(_near_pairs, PAIR)


def roots(forms: DataFrame) -> DataFrame:
    """The last form that each word's chain of forms leads to."""
    links = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stored(
            links.select("word", "root")
            .join(onward, "root", "left")
            .select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "roots",
        )
        if links.filter("moved").isEmpty():
            return links.drop("moved")


def spelling_variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Words of all texts with their near words, form and root."""
    words = stored(word_counts(docs), "words")
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        # The most frequent near word, of equally frequent ones the smallest.
        F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"),
    )
    frequent = -F.col("best.rank") >= ratio * F.col("n")
    found = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"),
            F.when(frequent, -F.col("best.rank")).alias("form_n"),
        ),
        "near-words",
    )
    last = roots(found.filter("form IS NOT NULL"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
