"""The ordered rule list and the columns derived from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, "str | Column"]

# Labels, thresholds, country list and prefix. Order matters, the
# first rule that holds names the alert.
DEFAULT_RULES: tuple[Rule, ...] = (
    ("HIGH_AMOUNT", "amount > 9000"),
    ("HIGH_RISK_COUNTRY", "country IN ('NG', 'CN', 'RU', 'UA') AND amount > 500"),
    ("SUSPICIOUS_IP", "startswith(ip_address, '185.')"),
    ("AMEX_LARGE", "card_type = 'amex' AND amount > 5000"),
    ("VELOCITY_FRAUD", "velocity_flag"),
)


def predicate(rule: Rule) -> Column:
    """A rule's condition, given as SQL text or as a Column."""
    condition = rule[1]
    return F.expr(condition) if isinstance(condition, str) else condition


def fraud_reason(rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """Label of the first rule that holds, NULL when none does."""
    labels = [F.when(predicate(rule), F.lit(rule[0])) for rule in rules]
    return F.coalesce(*labels, F.lit(None).cast("string"))


def any_rule(rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """Whether some rule holds. NULL when none holds but one is undecided."""
    return reduce(or_, map(predicate, rules), F.lit(False))


def no_rule(rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """Negation of :func:`any_rule`, hence NULL for the same rows."""
    return ~any_rule(rules)
