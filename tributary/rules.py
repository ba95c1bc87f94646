"""Cleaning rule sets.

``AS_CODED`` reproduces the behaviour of the original pipeline exactly,
including its quirks (unreachable day-first date branch, character-class price
stripping, truncating customer padding, placeholder product codes kept as
values). ``DOCUMENTED`` applies the behaviour its documentation describes.
Each quirk is one flag, so a deployment can move from one to the other one
rule at a time; the pipeline itself never forks.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class CleaningRules:
    # Dates: when True, ``dd/MM/yyyy`` is tried after ``MM/dd/yyyy`` fails.
    day_first_fallback: bool = False
    # Prices: when True, currency tokens are stripped only at the ends and a
    # decimal comma is honoured; when False, a character class is stripped.
    currency_tokens: bool = False
    # Customer ids: when True, no-digit ids become NULL and long ids are kept
    # whole; when False, ``lpad(..., 5)`` truncates and '' pads to 00000.
    strict_customer_id: bool = False
    # Products: when True, placeholder codes ('', MISSING, NULL, N/A) are NULL.
    null_product_placeholders: bool = False
    # Mobile epoch 0 is a missing timestamp rather than 1970-01-01.
    zero_epoch_is_null: bool = False
    # Quality score floored at 0 (tiers are unaffected).
    clamp_score: bool = False

    def with_(self, **changes) -> "CleaningRules":
        return replace(self, **changes)


AS_CODED = CleaningRules()
DOCUMENTED = CleaningRules(
    day_first_fallback=True,
    currency_tokens=True,
    strict_customer_id=True,
    null_product_placeholders=True,
    zero_epoch_is_null=True,
    clamp_score=True,
)
