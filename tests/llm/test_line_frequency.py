"""Documents that hold a line, whatever stands next to it."""

import random

import duckdb

from txrisk.llm import quality_rules
from txrisk.llm.queries import ORACLES


def prose(seed, n=60):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n))


FOOTER = "licensed under these terms\nall rights are kept\nby the owners of the site"


def test_every_line_of_a_block_is_counted(documents):
    rows = [(i, f"{prose(i)}\n{FOOTER}", "h") for i in range(30)]
    rows += [(100 + i, prose(100 + i), "h") for i in range(30)]
    # one document in thirty copies is one holder
    rows += [(200 + i, f"{prose(999)}\n{prose(998)}", "h") for i in range(30)]
    kept = {r.doc_id: r.text for r in quality_rules.kept_documents(documents(rows)).collect()}
    assert kept == {r[0]: r[1].removesuffix("\n" + FOOTER) for r in rows}


def test_the_share_decides_in_small_sources_too(documents):
    rows = [(i, f"{prose(i)}\n{FOOTER}", "ten") for i in range(10)]
    rows += [(100 + i, prose(7000 + i) + f"\n{FOOTER}" * (i < 3), "many") for i in range(140)]
    rows += [(300 + i, prose(8000 + i) + f"\n{FOOTER}" * (i < 3), "more") for i in range(160)]
    rows += [(500 + i, prose(9000 + i) + f"\n{FOOTER}" * (i < 2), "few") for i in range(5)]
    rows += [(600 + i, f"{prose(9500)}\n{prose(9600 + i, 5)}", "small") for i in range(4)]
    found = {r.doc_id: r for r in quality_rules.quality_rules(documents(rows)).collect()}
    cut = {i for i, r in found.items() if r.removed_words}
    assert cut == {*range(10), 100, 101, 102, *range(600, 604)}
    # a document that is nothing but a line of its source is depleted
    assert {i for i, r in found.items() if not r.kept} == {*range(600, 604)}


def test_twin_removes_the_same_lines(spark, documents, numbered_lines):
    """On texts of which some are depleted, the query's SQL says the same."""
    footer = "All rights\tRESERVED 2024 by  the publisher of this page\n" * 2 + "imprint 17"
    rows = [(i, numbered_lines(1000 + i) + "\n" + footer, f"s{i % 2}") for i in range(60)]
    rows += [(100 + i, numbered_lines(1) + f"\nown words {i} " + "x " * 3, "s0") for i in range(9)]
    rows += [(200, footer * 30, "s1"), (201, None, "s1"), (202, "", None), (203, rows[0][1], "s0")]
    docs = documents(rows)
    table = docs.toPandas()
    duck = duckdb.connect()
    duck.register("documents", table)
    columns = ["doc_id", "n_words", "n_repeat_words", "removed_words", "base_failed", "kept"]
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES['op6_quality_rules']})").fetchall()
    got = [tuple(r) for r in quality_rules.quality_rules(docs).select(*columns).collect()]
    assert sorted(got) == sorted(want)
    assert any(kept == failed for *_, failed, kept in got), "a document is depleted"
