"""Spelling variants against an edit distance between all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pandas as pd
import pytest

from txrisk.llm import spelling_variants as sv

DOCS = "doc_id BIGINT, text STRING, word STRING, n INT, block STRING"


def frequent_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            key = f"{'' if doc_id is None else doc_id}:{run}"
            h = zlib.crc32(key.encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(docs):
    counts = frequent_words(docs)
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    forms = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        return root(forms[w]) if forms[w] else w

    return {
        (w, forms[w], root(w), counts[w], len(near[w]), counts.get(forms[w])) for w in counts
    }


def variants(spark, docs):
    df = spark.createDataFrame([(*d, "x", 1, "y") for d in docs], DOCS)
    rows = sv.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len({r.word for r in rows})
    return {tuple(r) for r in rows}


@pytest.fixture(scope="module")
def sample():
    rnd = random.Random(5)
    base = ["".join(rnd.choices("abéc", k=rnd.randint(5, 9))) for _ in range(120)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "ÉCOLE", "École", "x" * 60, "x" * 59 + "y", "x" * 61]
    base += ["straße", "strasse", "a×b÷c", "WörTer", "wörter", "a" * 5000, "a" * 4999 + "b"]
    docs = []
    for i in range(400):
        words = rnd.choices(base, weights=[1 + k % 40 for k in range(len(base))], k=40)
        docs.append((i, rnd.choice([" ", "\n", "-", "1", "ł"]).join(words)))
    docs.append((1000, "chainn " * 4 + "chainm " * 9 + "chaimm " * 20))
    docs += [(None, "aaaaa aaaab"), (None, None), (7, ""), (7, docs[7][1]), (8, None)]
    return docs


def test_variants_are_brute_force(spark, sample):
    got = variants(spark, sample)
    assert got == expected(sample)
    assert any(form and root != form for _, form, root, *_ in got), "a chain of forms"


def test_tiles_lose_and_repeat_no_pair(spark, sample, monkeypatch):
    """Blocks cut into many small tiles, slices of one unit, small batches."""
    words = spark.createDataFrame(list(frequent_words(sample).items()), "word string, n bigint")
    rows = sv.units(sv.block_entries(words), tile=3)
    assert rows.filter("lo <> hi").count() > 0
    monkeypatch.setattr(sv, "CELLS", 50)
    pairs = []
    table = rows.orderBy(*sv.UNIT).toPandas()
    batches = [table.iloc[i : i + 7] for i in range(0, len(table), 7)]
    for part in sv._near_pairs([pd.DataFrame(columns=table.columns), *batches]):
        pairs += zip(part["word"], part["near"])
    counts = frequent_words(sample)
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in counts for b in counts if one_edit(a, b)}


def test_nothing_to_group(spark):
    assert variants(spark, []) == set()
    assert variants(spark, [(1, None), (2, ""), (3, "once upon a time there")]) == set()
    assert variants(spark, [(1, "alone " * 3)]) in (
        {("alone", None, "alone", 3, 0, None)}, set(),
    )


def test_long_texts_are_searched_whole(monkeypatch):
    text = "Wörter UND wörtér " * 50
    whole = sv.text_words("3", text)
    monkeypatch.setattr(sv, "LONG_TEXT", 10)
    assert sv.text_words("3", text) == whole and sum(whole.values()) == 100
