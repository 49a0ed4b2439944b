"""PII detection and redaction as built-in expressions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import computed_once


def pii_counts(text: Column, entities: Sequence[str] = tuple(P.PII_ENTITIES),
               max_chars: int = 10000) -> Column:
    """array<int> of match counts per entity over the first ``max_chars``
    characters.  Stage it in its own column: ``detect_pii_from_counts``
    reads each element several times."""
    scanned = F.substring(text, 1, max_chars) if max_chars and max_chars > 0 else text
    entities = tuple(entities)
    if not entities:
        return F.array().cast("array<int>")

    def count(t: Column, no_number: Column) -> Column:
        out = []
        for name in entities:
            n = F.regexp_count(t, F.lit(P.PII_J[name]))
            if name in P.PII_NUMBERS:
                n = F.when(no_number, F.lit(0)).otherwise(n)
            need = P.PII_REQUIRED.get(name)
            if need:
                n = F.when(t.contains(need), n).otherwise(F.lit(0))
            out.append(n.cast("int"))
        return F.array(*out)

    return computed_once(scanned, lambda t: computed_once(~t.rlike(P.PII_NUMBERS_J), lambda none: count(t, none)))


def detect_pii_from_counts(counts: Column, entities: Sequence[str] = tuple(P.PII_ENTITIES),
                           max_matches: int = 2) -> Column:
    """struct<has_pii, pii_types, pii_count>: entities in the given order,
    the scan stopping after ``max_matches`` hits in total; entity i
    contributes ``least(n_i, budget left)``.  A budget <= 0 scans only the
    first entity, for at most one hit."""
    entities = [e for e in entities if e in P.PII_J]
    if not entities:
        return empty_pii()
    if int(max_matches) <= 0:
        # the budget is already spent after the first entity's scan: only
        # that entity is looked at, and one hit ends it
        counts = F.slice(counts, 1, 1)
        entities = entities[:1]
    budget = max(int(max_matches), 1)
    left = F.lit(budget)
    parts, ks = [], []
    for i, name in enumerate(entities):
        k = F.least(F.element_at(counts, i + 1), left)
        parts.append(F.array_repeat(F.lit(name), k))
        ks.append(k)
        left = F.lit(budget) - sum(ks[1:], ks[0])
    count = F.least(F.lit(budget), F.aggregate(counts, F.lit(0), lambda a, x: a + x)).cast("int")
    return F.struct((count > 0).alias("has_pii"), F.flatten(F.array(*parts)).alias("pii_types"),
                    count.alias("pii_count"))


def detect_pii(text: Column, entities: Sequence[str] = tuple(P.PII_ENTITIES),
               max_chars: int = 10000, max_matches: int = 2) -> Column:
    """Single-expression form: the counts are the one element of an array, so
    that they are taken once and not at each of their uses."""
    entities = tuple(e for e in entities if e in P.PII_J)
    counts = F.array(pii_counts(text, entities, max_chars))
    return F.transform(counts, lambda n: detect_pii_from_counts(n, entities, max_matches))[0]


def empty_pii() -> Column:
    return F.struct(
        F.lit(False).alias("has_pii"),
        F.array().cast("array<string>").alias("pii_types"),
        F.lit(0).alias("pii_count"),
    )


def has_unredacted_pii(text: Column) -> Column:
    """Export-time check: e-mail, phone or card anywhere in the whole text,
    case-sensitive (the top-level domain must be upper case)."""
    return (
        text.rlike(P.PII_CASED_J["EMAIL_ADDRESS"])
        | text.rlike(P.PII_CASED_J["PHONE_NUMBER"])
        | text.rlike(P.PII_CASED_J["CREDIT_CARD"])
    )


def redact_pii(text: Column) -> Column:
    """Replace e-mail, phone, card and SSN matches, in that order."""
    out = text
    for name, label in P.REDACTION_LABELS:
        out = F.regexp_replace(out, P.PII_CASED_J[name], label)
    return out
