"""Pages whose nearest URLs are short texts on a long template, or versions."""

import random

import pytest

from txrisk.llm import html_text

TEMPLATE = [f"Template block {k} with links to shops, terms and help number {k}" for k in range(40)]


def prose(seed, n=30):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def page(*lines):
    blocks = [*TEMPLATE[:20], *lines, *TEMPLATE[20:]]
    return "<html><body>" + "".join(f"<div>{x}</div>" for x in blocks) + "</body></html>"


@pytest.fixture
def texts(spark):
    def of(*pages):
        rows = [(i, f"http://h.org/{i:03}", p) for i, p in enumerate(pages)]
        df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").coalesce(1)
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        try:
            return [r.text for r in html_text.extract(df).orderBy("page_id").collect()]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    return of


def test_short_texts_on_a_long_template(texts):
    short = [prose(i, 8) for i in range(5)]
    assert texts(*map(page, short)) == short


def test_versions_are_passed_over_for_the_next_page(texts):
    body = [prose(k) for k in range(4)]
    edited = [[*body[:3], " ".join([*body[3].split()[:-1], f"edit{v}"])] for v in range(5)]
    first, last = prose(90), prose(91)
    found = texts(page(first), *(page(*e) for e in edited), page(last))
    assert found == [first, *(" ".join(e) for e in edited), last]
    # at the end of the host only the page before the run is left
    assert texts(page(first), *(page(*e) for e in edited)) == found[:-1]
    assert texts(*(page(*e) for e in edited), page(last)) == found[1:]


def test_a_version_with_one_more_line_is_a_version():
    body = [prose(k) for k in range(4)]
    more, less = (html_text.parse(page(*x)) for x in ([*body, "One line was added"], body))
    assert html_text.template_lines(more, less, 0.8) is None
    assert html_text.template_lines(less, more, 0.8) is None
