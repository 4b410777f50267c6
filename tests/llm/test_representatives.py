"""One row of each component of near duplicates, whatever the ids."""

import random

from txrisk.llm import ngram_join


def prose(seed, n=80):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_repeated_rows_missing_ids_and_shared_ids(documents):
    repeated, unnamed, mixed = prose(1), prose(2), prose(3)
    rows = [(1, repeated, "b"), (1, repeated, "a"), (1, repeated, "b"), (2, repeated + " x")]
    # no member has an id
    rows += [(None, unnamed), (None, unnamed), (None, unnamed + " x")]
    # a NULL id comes after all others
    rows += [(None, mixed), (9, mixed + " x")]
    # one id, texts that have nothing in common
    rows += [(20, prose(4)), (20, prose(5)), (21, prose(4) + " x"), (21, prose(5) + " x")]
    rows += [(None, " "), (None, None), (30, "")]
    kept = ngram_join.representatives(documents(rows)).collect()
    assert sorted((str(r.doc_id), r.text[:80], r.source) for r in kept if r.text and r.text.strip()
                  and r.doc_id is not None) == sorted([
        ("1", repeated[:80], "a"), ("9", mixed[:80], "s"),
        ("20", prose(4)[:80], "s"), ("20", prose(5)[:80], "s"),
    ])
    nameless = [r.text for r in kept if r.doc_id is None and r.text and r.text.strip()]
    assert len(nameless) == 1 and nameless[0][:80] == unnamed[:80]
    assert len(kept) == 4 + 1 + 3
