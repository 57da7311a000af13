"""Traffic-light rules of the tower classification reports.

A rule is data: which values give which colour, and what NULL and any other value give. ``Rule.column`` turns it into one
CASE expression, so a report with fifteen rules is still a single projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

GREEN, YELLOW, RED, BLANK = "GREEN", "YELLOW", "RED", ""

# ---- fixed values -------------------------------------------------------------------------------------------------
MAST_TYPES = ("GUYED", "MONOPOLE", "SELF SUPPORT")
NODE_TYPES = ("DAS NODE", "ROOFTOP", "SINGLE USE", "STEALTH")
OLD_NODE_TYPES = ("DAS", "ROOFTOP", "SINGLE USE", "STEALTH")
VAGUE_TYPES = ("COMPOUND", "OTHER", "UNCLASSIFIED")
ZONING_STEPS = ("Admin", "Concurrent", "Full", "Over Counter")
PERMITS = ("BP", "BP + EP", "Other", "BP + Other", "Electrical")
PERMITS_BUT_BP = ("BP + EP", "BP + Other", "Other", "Electrical")
CONSENT_NEEDED = (
    "Consent - No Standard Specified (NTBUW)", "Consent - Non-Standard Requirement", "Consent - NTBUW", "Notice",
)
CONSENT_FREE = (
    "Consent - Intercompany", "No Consent or Notice Required", "No Consent or Notice Required - IC Blanket Agreement",
    "No Consent or Notice Required - Silent",
)
SOLE_DISCRETION = ("Consent - Sole Discretion",)
# The oldest report spells two of them with a double blank and knows one more.
OLD_CONSENT_NEEDED = (
    "Consent - Deemed Approved", "Consent - No Standard Specified (NTBUW)", "Consent - Non-Standard Requirement",
    "Consent  NTBUW", "Notice",
)
OLD_CONSENT_FREE = (
    "Consent - Intercompany", "No Consent or Notice Required", "No Consent or Notice Required - IC Blanket Agreement",
    "No Consent or Notice Required  Silent",
)
FIBRE_NAMES = "(?i)(fiber app|crown castle|lightower|sunesys|wilcon)"
LEASE_DAYS = 1825
# -------------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Colour of one input column.

    ``colours`` maps a colour to the values that give it, ``other`` is for values not listed, ``null`` for NULL.
    """

    source: str
    colours: dict[str, tuple[str, ...]]
    other: str | None
    null: str | None
    prefixes: dict[str, str] = field(default_factory=dict)

    def column(self) -> Column:
        value = F.col(self.source)
        out = F.when(value.isNull(), F.lit(self.null))
        for prefix, colour in self.prefixes.items():
            out = out.when(value.startswith(prefix), colour)
        for colour, values in self.colours.items():
            out = out.when(value.isin(*values), colour)
        return out.otherwise(F.lit(self.other))


def structure(nodes=NODE_TYPES, other: str = RED, null: str = RED, source: str = "s_structure_type") -> Rule:
    return Rule(source, {GREEN: MAST_TYPES, RED: nodes, YELLOW: VAGUE_TYPES}, other, null)


def yes_is_red(source: str, null: str | None) -> Rule:
    """Y is RED, any other value GREEN."""
    return Rule(source, {RED: ("Y",)}, GREEN, null)


def blank_is_green(source: str, other: str, null: str) -> Rule:
    return Rule(source, {GREEN: ("",)}, other, null)


def no_is_green(source: str) -> Rule:
    """No or NULL is GREEN, Yes RED, anything else has no colour."""
    return Rule(source, {GREEN: ("No",), RED: ("Yes",)}, None, GREEN)


CONSENT = Rule(
    "sublease_consent_type",
    {GREEN: ("Consent - Intercompany",), YELLOW: CONSENT_NEEDED, RED: SOLE_DISCRETION},
    GREEN, GREEN, {"No Consent": GREEN},
)
CONSENT_SUMMARY = Rule(
    "sublease_consent_type", {GREEN: CONSENT_FREE, YELLOW: CONSENT_NEEDED, RED: SOLE_DISCRETION}, BLANK, BLANK
)
CAPACITY_KNOWN = Rule("current_tower_capacity", {}, GREEN, RED)
ZONING = Rule("zoning_collo_process_type", {YELLOW: ZONING_STEPS}, GREEN, GREEN)
PERMIT = Rule("bp_collo_permit_type", {RED: PERMITS, GREEN: ("None",)}, RED, RED)
PERMIT_GRADED = Rule("bp_collo_permit_type", {RED: ("BP",), YELLOW: PERMITS_BUT_BP, GREEN: ("None",)}, RED, RED)
STATUS = Rule("site_status", {GREEN: ("Active",)}, RED, RED)
PROPERTY = Rule("primary_property_interest", {YELLOW: ("MANAGED",), GREEN: ("LEASED",)}, BLANK, BLANK)


def zoning_step(source: str) -> Rule:
    return Rule(source, {YELLOW: ZONING_STEPS, GREEN: ("No Zoning",)}, BLANK, BLANK)


def permit_step(source: str) -> Rule:
    return Rule(source, {YELLOW: PERMITS, GREEN: ("None",)}, BLANK, BLANK)


def site_flag(source: str) -> Rule:
    return Rule(source, {GREEN: ("1",)}, RED, BLANK)


def capacity_text(source: str = "current_tower_capacity") -> Column:
    """The capacity is compared as text, so '90' is above '200' and '1000' below it."""
    value = F.col(source)
    return (
        F.when(value.isNull() | (value == "N/A"), BLANK).when(value < "200", GREEN).otherwise(RED)
    )


def property_text(source: str = "primary_property_interest") -> Column:
    """MANAGED is YELLOW; any text from 'LEASED' upwards is GREEN."""
    value = F.col(source)
    return F.when(value == "MANAGED", YELLOW).when(value >= "LEASED", GREEN).otherwise(BLANK)


def lease_colour(days: Column) -> Column:
    """YELLOW for less than five years, GREEN from there, NULL once the lease has ended."""
    return F.when((days > 0) & (days < LEASE_DAYS), YELLOW).when(days >= LEASE_DAYS, GREEN)


def lease_colour_two_way(days: Column) -> Column:
    return F.when(days < LEASE_DAYS, YELLOW).when(days >= LEASE_DAYS, GREEN)


def category(columns: list[str]) -> Column:
    """GREEN if all are GREEN, RED if any is RED, else YELLOW (also for a colour that is NULL)."""
    colours = F.array(*[F.col(c) for c in columns])
    any_red = reduce(lambda a, b: a | b, [F.col(c).eqNullSafe(RED) for c in columns])
    return F.when(F.forall(colours, lambda c: c == GREEN), GREEN).when(any_red, RED).otherwise(YELLOW)


def fibre_type(on_site: str = "fiber_on_site", provider: str = "fiber_provider") -> Column:
    has_fibre, named = F.col(on_site) == "Yes", F.col(provider)
    return (
        F.when(has_fibre & named.rlike(FIBRE_NAMES), "LIT")
        .when(has_fibre & ~named.rlike(FIBRE_NAMES) & named.isNotNull(), "LIT RESTRICTED")
        .when(F.col(on_site) == "No", "UNLIT")
    )
