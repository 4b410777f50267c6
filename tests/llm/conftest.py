import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples."""

    def build(rows, extra: str | None = None):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.selectExpr("*", f"'x' AS {extra}") if extra else df

    return build


def lines_of(*numbers, words=30):
    """Text of lines that differ by number."""
    return "\n".join(" ".join(f"w{n}x{k}" for k in range(words)) for n in numbers)


@pytest.fixture
def numbered_lines():
    return lines_of
