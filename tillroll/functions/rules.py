"""Ordered regex rewrite rules (D07, D08) as a fold of ``regexp_replace``.

A rule set is data: a list of (pattern, replacement) applied in order, each
to the output of the previous one.  Catalyst collapses the fold into a single
projection, so a rule set costs one pass however long it is.  An optional
guard restricts a group of rules to texts containing a trigger word.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The localisation rule lists of the source project, in their
# original order.  Java regex syntax; (?i) marks case-insensitive rules.
# ---------------------------------------------------------------------------
PLACE_RULES = [
    (r"\bI LOVE LONDON\b", "I LOVE MALAYSIA"),
    (r"\bLONDON BUS\b", "KL MONORAIL"),
    (r"\bLONDON BRIDGE\b", "PETRONAS TOWERS"),
    (r"\bLONDON\b", "KL"),
    (r"\bPARIS FASHION\b", "KL FASHION"),
    (r"\bFRENCH STYLE\b", "COLONIAL STYLE"),
    (r"\bNEW ENGLAND\b", "PERANAKAN"),
    (r"\bENGLISH ROSE\b", "BATIK FLORAL"),
    (r"\bUNION (JACK|FLAG)\b", "HIBISCUS PRINT"),
    (r"\bJUBILEE\b", "MERDEKA"),
]

CHARACTER_RULES = [
    (r"(?i)CHARLIE\s*(\+|AND|&)?\s*LOLA", "KIDS DESIGN"),
    (r"(?i)LARRY THE LAMB", "CUTE LAMB"),
]

EASTER_TRIGGER = "EASTER"
EASTER_RULES = [
    (r"(?i)EASTER", "RAYA"),
    (r"(?i)BUNNIES", "KETUPAT"),
    (r"(?i)BUNNY", "KETUPAT"),
    (r"(?i)RABBIT", "KETUPAT"),
    (r"(?i)CHICKS", "LANTERNS"),
    (r"(?i)CHICK", "LANTERN"),
    (r"(?i)EGGS", "COOKIES"),
    (r"(?i)EGG", "COOKIE"),
]

CLIMATE_RULES = [
    (r"\bWOOLLY HOTTIE\b", "INSULATED TUMBLER"),
    (r"\bHOTTIE\b", "TUMBLER"),
    (r"\bHOT WATER BOTTLE\b", "INSULATED TUMBLER"),
    (r"\bMINI HAND WARMER\b", "MINI FAN"),
    (r"\bHAND WARMER\b", "MINI FAN"),
    (r"\bPOCKET WARMER\b", "POCKET FAN"),
    (r"\bEGG WARMER\b", "MUG WARMER"),
    (r"\bEGG COSY\b", "MUG COSY"),
    (r"\bSCARF KNITTING KIT\b", "BATIK PAINTING KIT"),
    (r"\bSCARF\b", "SARONG"),
]


@dataclass(frozen=True)
class RuleStage:
    rules: list[tuple[str, str]]
    guard: str | None = None  # upper(text) must contain this word for the stage to fire


@dataclass(frozen=True)
class RuleSet:
    stages: list[RuleStage] = field(default_factory=list)


PLACE_RULESET = RuleSet([RuleStage(PLACE_RULES)])
CLIMATE_RULESET = RuleSet([RuleStage(CHARACTER_RULES),
                           RuleStage(EASTER_RULES, guard=EASTER_TRIGGER),
                           RuleStage(CLIMATE_RULES)])


def fold_rules(text: Column, rules: list[tuple[str, str]]) -> Column:
    out = text
    for pattern, repl in rules:
        out = F.regexp_replace(out, pattern, repl)
    return out


def any_rule_pattern(rules: list[tuple[str, str]]) -> str:
    """One alternation matching wherever any rule of the stage would match
    (a leading inline ``(?i)`` becomes a scoped ``(?i:...)`` group)."""
    parts = []
    for pattern, _ in rules:
        parts.append(f"(?i:{pattern[4:]})" if pattern.startswith("(?i)") else f"(?:{pattern})")
    return "|".join(parts)


_META = set(".^$*+?()[]{}|\\")


def required_literal(pattern: str) -> str | None:
    """For a pattern that is a plain word sequence between optional word
    boundaries, the literal any match must contain; otherwise None."""
    p = pattern
    if p.startswith("\\b"):
        p = p[2:]
    if p.endswith("\\b"):
        p = p[:-2]
    return p if p and not any(c in _META for c in p) else None


def stage_may_change(text: Column, rules: list[tuple[str, str]]) -> Column:
    """A necessary condition for any rule of the stage to change ``text``:
    a byte search for plain literals, one regex scan for the other patterns."""
    conds = []
    rest = []
    for pattern, repl in rules:
        lit = required_literal(pattern)
        if lit is None:
            rest.append((pattern, repl))
        else:
            conds.append(text.contains(lit))
    if rest:
        conds.append(text.rlike(any_rule_pattern(rest)))
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def apply_ruleset(text: Column, ruleset: RuleSet) -> Column:
    """NULL stays NULL (regexp_replace is null-safe).

    Each stage first checks a necessary condition (literal byte search, or one
    regex scan for patterns that are not plain words) and runs the ordered fold
    only where it holds: if no pattern matches the input, no rule changes it,
    so the result is identical and most texts cost a few byte scans instead of
    one regex pass per rule.  A stage guard is evaluated after that check.
    """
    out = text
    for stage in ruleset.stages:
        hit = stage_may_change(out, stage.rules)
        if stage.guard is not None:
            hit = hit & F.upper(out).contains(stage.guard)
        out = F.when(hit, fold_rules(out, stage.rules)).otherwise(out)
    return out
