"""Data-quality rules as data.

A rule is a name, a SQL predicate over the silver columns and an action:
``warn`` keeps the row and counts it, ``drop`` removes and counts it, ``fail``
aborts the run.  A predicate that evaluates to NULL counts as a violation
(``coalesce(pred, false)``), so a NULL qty is both dropped *and* counted.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, got {self.action!r}")

    def passed(self, as_of: str | None = None) -> Column:
        """Boolean column, never NULL: TRUE only when the predicate holds."""
        return F.coalesce(F.expr(bind_now(self.predicate, as_of)), F.lit(False))


_NOW = re.compile(r"current_timestamp\s*\(\s*\)|\bnow\s*\(\s*\)", re.IGNORECASE)


def bind_now(predicate: str, as_of: str | None) -> str:
    """Replace ``current_timestamp()`` by a fixed instant (deterministic tests, H10)."""
    if as_of is None:
        return predicate
    return _NOW.sub(f"TIMESTAMP '{as_of}'", predicate)


# Fixed values that must equal the reference's rule set (names, predicates,
# actions) — the silver contract of the order pipeline.
DEFAULT_RULES = (
    Expectation("valid_order_id", "order_id IS NOT NULL", "drop"),
    Expectation("valid_store", "store_id IS NOT NULL", "drop"),
    Expectation("positive_qty", "qty > 0", "drop"),
    Expectation("non_negative_amount", "line_amount >= 0", "warn"),
    Expectation("known_channel", "channel IN ('DINE_IN','TAKEAWAY','DELIVERY','DRIVE_THRU','KIOSK')", "warn"),
    Expectation("plausible_timestamp", "order_ts <= current_timestamp()", "warn"),
    Expectation("currency_is_inr", "currency = 'INR'", "fail"),
)


def rules_from_dict(rules: dict[str, str], action: str = "warn") -> list[Expectation]:
    """A dict of rules sharing one action, ``{name: predicate}`` → rules."""
    return [Expectation(k, v, action) for k, v in rules.items()]
