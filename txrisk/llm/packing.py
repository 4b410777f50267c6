"""Packing token sequences (operator 8).

Documents are tokenized and cut into pieces of at most ``length`` tokens. A full
piece is a sequence of its own. The remainders are dealt at random into groups
of bounded size, and each group is packed on its own by first-fit decreasing: a
tournament tree over the free space of its sequences gives the first one with
room in logarithmic time. Groups are large enough that what remains free in
their last sequences hardly counts.

Groups come from a hash of the row's number, so neither a frequent document nor
a frequent id can fill one. Pieces are stored before they are packed, because
tokenizing is the expensive part.

Defined results: a NULL text is empty; every document, an empty one too, ends
with the end id; repeated rows are documents of their own; an empty table gives
an empty result.
"""

from __future__ import annotations

import sys
import types
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import body_text, stored

LENGTH = 2048
END_ID = 1
GROUP = 8192
# Words whose ids a worker keeps; beyond that it starts anew.
KEPT_WORDS = 600_000
ID_BYTES = 4

Encode = Callable[[str], bytes]


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def word_encoder(path: str, added_tokens: bool = False) -> Encode:
    """Ids of a text, as little-endian 32-bit integers, from a word-level
    tokenizer, one whose rules never look across white space.

    Words are tokenized once and looked up afterwards. ASCII case is folded
    first, as the tokenizer folds it, and closing punctuation after a letter is
    a token of its own, so both can be done on the bytes. A word of Latin
    letters goes straight to the vocabulary's model, any other through the
    whole tokenizer.

    With ``added_tokens`` the text of an added token, such as an end mark, gets
    that token's id, as the library does by itself; a text that may hold one is
    tokenized whole. Without, it is text like any other.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not added_tokens
    model, letters = tokenizer.model, _byte_letters()
    known: dict[bytes, bytes] = {}
    # Compared without case: some tokenizers fold a text before they look.
    marks = [t.content.encode().lower() for t in tokenizer.get_added_tokens_decoder().values()]
    marks = marks if added_tokens else []

    def as_bytes(ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(ID_BYTES, "little") for i in ids)

    def learn(word: bytes) -> bytes:
        bare = word.rstrip(b".,!?")
        if bare != word and bare[-1:].isalpha():
            return find(bare) + find(word[len(bare) :])
        text = word.decode()
        if text.isalpha() and max(text) < "ɐ":
            folded = unicodedata.normalize("NFC", text).lower()
            if folded.isalpha():
                spelled = "".join(letters[b] for b in folded.encode())
                return as_bytes([t.id for t in model.tokenize(spelled)])
        return as_bytes(tokenizer.encode(text, add_special_tokens=False).ids)

    def find(word: bytes) -> bytes:
        ids = known.get(word)
        if ids is None:
            ids = known[word] = learn(word)
        return ids

    def encode(text: str) -> bytes:
        folded = text.encode("utf-8", "replace").lower()
        if any(mark in folded for mark in marks):
            return as_bytes(tokenizer.encode(text, add_special_tokens=False).ids)
        found = folded.split()
        if len(known) > KEPT_WORDS:
            known.clear()
        for word in set(found):
            find(word)
        return b"".join(map(known.__getitem__, found))

    return encode


def worker_encoder(path: str, added_tokens: bool = False) -> Encode:
    """The encoder that this worker process keeps from task to task."""
    kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders"))
    key = f"{added_tokens} {path}"
    if key not in kept.__dict__:
        kept.__dict__[key] = word_encoder(path, added_tokens)
    return kept.__dict__[key]


PIECES = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary,"
    " full_id bigint, item bigint, _group bigint"
)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    length: int,
    end_id: int,
    groups: int,
    with_ids: bool,
    added_tokens: bool = False,
) -> DataFrame:
    """Pieces of all documents. ``full_id`` numbers the full ones, ``item`` is
    the document's row number and ``_group`` its group."""
    row = F.monotonically_increasing_id()
    rows = docs.select(
        "doc_id", body_text().alias("text"), row.alias("item")
    ).withColumn("_group", F.pmod(F.xxhash64("item"), F.lit(groups)))
    end = end_id.to_bytes(ID_BYTES, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(tokenizer, added_tokens)
        next_full = TaskContext.get().partitionId() << 33
        for batch in batches:
            columns = batch.columns
            out: list[tuple] = []
            source: list[int] = []
            for i, text in enumerate(columns[1]):
                ids = encode(text.as_py()) + end
                total = len(ids) // ID_BYTES
                for start in range(0, total, length):
                    part = ids[start * ID_BYTES : (start + length) * ID_BYTES]
                    size, full = len(part) // ID_BYTES, None
                    if size == length:
                        full, next_full = next_full, next_full + 1
                    source.append(i)
                    kept = part if with_ids else None
                    out.append((start, size, zlib.crc32(part), total, kept, full))
            at = pa.array(source, pa.int64())
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            named = list(zip(*out)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [
                    columns[0].take(at),
                    *(pa.array(v, k) for v, k in zip(named, kinds)),
                    columns[2].take(at),
                    columns[3].take(at),
                ],
                names=["doc_id", *(c.split()[0] for c in PIECES.split(", "))],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, {PIECES}")


class Tournament:
    """Free space of numbered bins, with the larger of two children in each
    inner node, so the first bin with enough room is found from the root."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Bin that takes ``size`` first, and the space it had left."""
        node, free = 1, self.free
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        left = free[node]
        free[node] -= size
        place = node - self.leaves
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
        return place, left


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset per size, the sizes in falling order."""
    tree = Tournament(len(sizes), capacity)
    placed = (tree.place(size) for size in sizes)
    return [(place, capacity - left) for place, left in placed]


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    group: int = GROUP,
    with_ids: bool = False,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``; with
    ``with_ids`` also the token ids as little-endian 32-bit integers. For
    ``added_tokens`` see :func:`word_encoder`."""
    groups = max(1, -(-docs.count() // group))
    cut = pieces(docs, tokenizer, length, end_id, groups, with_ids, added_tokens)
    cut = stored(cut, "pieces")
    result = ["start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Full pieces are numbered from 2 ** 62 on, above all numbers of groups.
    full = cut.filter(F.col("full_id").isNotNull()).select(
        "doc_id",
        *result,
        (F.col("full_id") + F.lit(1 << 62)).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    types_ = {f.name: f.dataType.simpleString() for f in cut.schema}
    schema = ", ".join([f"doc_id {kind}", *(f"{c} {types_[c]}" for c in result)])

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "item"], ascending=[False, True])
        placed = first_fit_decreasing(rows["length"].tolist(), length)
        rows["sequence_id"] = [(key[0] << 33) + place for place, _ in placed]
        rows["offset"] = [offset for _, offset in placed]
        return rows[["doc_id", *result, "sequence_id", "offset"]]

    rest = (
        cut.filter(F.col("full_id").isNull())
        .groupBy("_group")
        .applyInPandas(fit, f"{schema}, sequence_id bigint, offset bigint")
    )
    return full.unionByName(rest)
