"""Account numbers that are followed by more capitals or digits."""

import pytest

from txrisk.llm import pii


@pytest.mark.parametrize(
    "text, numbers",
    [
        ("BE68 5390 0754 7034 BIC: X", ["BE68 5390 0754 7034"]),
        ("pay ES9121000418450200051332 BIC: X", ["ES9121000418450200051332"]),
        ("AT61 1904 3002 3457 3201 BIC A", ["AT61 1904 3002 3457 3201"]),
        ("NL91 ABNA 0417 1643 00 BIC", ["NL91 ABNA 0417 1643 00"]),
        (
            "BE68 5390 0754 7034 DE89 3704 0044 0532 0130 00",
            ["BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00"],
        ),
        ("REF AB12 CODE DE89370400440532013000", ["DE89370400440532013000"]),
        ("BE68 5390 0754 7035 BIC", []),
    ],
)
def test_numbers_end_where_they_are_valid(text, numbers):
    assert [text[a:b] for a, b in pii.iban_spans(text)] == numbers
    found = [text[s.start : s.end] for s in pii.find_spans(text) if s.kind == "iban"]
    assert found == numbers
