"""Column-expression helpers (all built-in Spark functions, JVM-side)."""

from strata.functions.money import amount_average, amount_total
from strata.functions.rules import Expectation, DEFAULT_RULES, rules_from_dict

__all__ = ["amount_average", "amount_total", "Expectation", "DEFAULT_RULES", "rules_from_dict"]
