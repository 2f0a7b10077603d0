"""Owner-name normalisers and the rule-driven entity classifier."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from auditloom import fixed
from auditloom.functions.numbers import col, let, strip


def has_any(text: Column, words: Sequence[str]) -> Column:
    """True where any of the literal ``words`` occurs; one compiled pattern for the list."""
    return text.rlike("|".join(re.escape(w) for w in words))


def clean_owner_name(c: Column | str) -> Column:
    """Drop embedded half-year tax amounts (``... FH 1,234.50 ...``); null is ''."""
    text = F.coalesce(col(c), F.lit(""))
    for mark in ("FH", "SH"):
        text = F.regexp_replace(text, rf"\s+{mark}\s+[\d,\.]+.*$", "")
    return strip(text)


def _rule_test(text: Column, kind: str, spec) -> Column:
    if kind == "words":
        return has_any(text, spec)
    if kind == "regex":
        return text.rlike(spec)
    if kind == "regex_unless_words":
        pattern, words = spec
        return text.rlike(pattern) & ~has_any(text, words)
    raise ValueError(f"unknown rule kind {kind!r}")


def classify_entity(name: Column | str, rules: str | Sequence[tuple] = "yearly",
                    default: str = fixed.ENTITY_DEFAULT) -> Column:
    """First rule that matches the upper-cased name gives the class.

    ``rules`` is the name of a rule set or a sequence of (class, kind, spec).
    The name is upper-cased once and each class costs at most one pattern search.
    """
    if isinstance(rules, str):
        rules = fixed.ENTITY_RULES[rules]
    def first_match(text: Column) -> Column:
        (label, kind, spec), *rest = rules
        chain = F.when(_rule_test(text, kind, spec), F.lit(label))
        for label, kind, spec in rest:
            chain = chain.when(_rule_test(text, kind, spec), F.lit(label))
        return chain.otherwise(F.lit(default))

    return let(F.upper(F.coalesce(col(name), F.lit(""))), first_match)


def word_boundary_rules(rules: str) -> tuple[tuple, ...]:
    """The rule set with each word list matched on whole words (no GAS in GASKINS)."""
    out = []
    for label, kind, spec in fixed.ENTITY_RULES[rules]:
        if kind == "words":
            words = sorted({w.strip() for w in spec}, key=lambda w: (-len(w), w))
            spec = r"(?<!\w)(?:" + "|".join(re.escape(w) for w in words) + r")(?!\w)"
            kind = "regex"
        out.append((label, kind, spec))
    return tuple(out)


def extract_last_name(name: Column | str,
                      entity_words: Sequence[str] = fixed.LAST_NAME_ENTITY_WORDS) -> Column:
    """``LAST, FIRST`` or ``LAST FIRST``; null for entities and single words."""
    def last_name(text: Column) -> Column:
        upper = F.upper(text)
        before_comma = F.regexp_replace(strip(F.split(text, ",").getItem(0)), fixed.NAME_SUFFIX, "")
        words = F.split(upper, r"\s+")
        first = words.getItem(0)
        return (F.when((text == "") | has_any(upper, entity_words), F.lit(None).cast("string"))
                .when(text.contains(","), F.upper(before_comma))
                .when((F.size(words) >= 2) & ~first.isin(list(fixed.LAST_NAME_ARTICLES)), first))

    return let(strip(F.coalesce(col(name), F.lit(""))), last_name)


def is_business(name: Column | str) -> Column:
    return has_any(F.upper(col(name)), fixed.BUSINESS_WORDS)


def extract_surname(raw: Column | str) -> Column:
    """First word (two after a particle such as VAN) of the text before a wide gap."""
    def surname(head: Column) -> Column:
        words = F.split(F.upper(head), r"\s+")
        first = words.getItem(0)
        compound = (F.size(words) >= 2) & first.isin(list(fixed.SURNAME_PARTICLES))
        return (F.when(is_business(head) | (head == ""), F.lit(None).cast("string"))
                .when(compound, F.concat_ws(" ", F.slice(words, 1, 2)))
                .when(F.length(first) >= 2, first))

    return let(strip(F.split(col(raw), r"\s{3,}").getItem(0)), surname)


def canonical_district(text: Column | str, districts: Mapping[str, str] = fixed.DISTRICTS) -> Column:
    """Display name of the first listed district found in the text, spaces ignored."""
    def first_found(squeezed: Column) -> Column:
        chain = None
        for key, label in districts.items():
            test = squeezed.contains(key)
            chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
        return chain

    return let(F.replace(F.upper(col(text)), F.lit(" "), F.lit("")), first_found)


def lookup(c: Column | str, table: Mapping, default: Column | str | None = None) -> Column:
    """Small fixed lookup as an expression: no join, nothing to broadcast."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    hit = F.element_at(F.create_map(*pairs), col(c))
    if default is None:
        return hit
    return F.coalesce(hit, default if isinstance(default, Column) else F.lit(default))
