"""Text functions as Column expressions.  Patterns carry (?U) where Python's classes are Unicode."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lanternflow import vocab
from lanternflow.functions.base import let

Taxonomy = Sequence[tuple[str, Sequence[str]]]


def any_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def clean_text(text: Column, longest: int | None = None) -> Column:
    """White space collapsed and trimmed; cut to ``longest`` characters with an ellipsis; null is empty."""
    clean = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "), "^ | $", "")
    if not longest:
        return clean
    cut = lambda s: F.concat(F.regexp_replace(F.substring(s, 1, longest - 1), " +$", ""), F.lit("…"))
    return let(clean, lambda s: F.when(F.length(s) > longest, cut(s)).otherwise(s))


def missing(c: Column) -> Column:
    """Empty counts as missing."""
    return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""


def pattern(p: str) -> str:
    return "(?iU)" + p


def context(text: Column, start: Column, length: Column, radius: int = 180) -> Column:
    """The text around a match that begins at 1-based ``start``."""
    first = F.greatest(start - radius, F.lit(1))
    return F.substring(text, first, start + length + radius - first)


def matches(text: Column, p: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(p), F.lit(group))


def matches_in_context(text: Column, p: str, radius: int = 180) -> Column:
    """array<struct<value, around>> of a pattern's matches, by splitting at them: no offsets, no Python.

    The pieces between matches and the matches alternate, so a match's place is the length of what precedes it."""
    found, between = matches(text, p), F.split(text, p)
    start = lambda i: F.aggregate(F.slice(between, F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(F.slice(found, F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x)) + 1
    return F.transform(found, lambda m, i: F.struct(m.alias("value"), context(text, start(i), F.length(m), radius).alias("around")))


def first_in_context(text: Column, p: str, holds, radius: int = 180) -> Column:
    """struct<value, around> of the first match whose surroundings hold, else null."""
    return F.get(F.filter(matches_in_context(text, p, radius), lambda m: holds(m["around"])), F.lit(0))


def location(text: Column) -> Column:
    """struct(state, city): the longest state named and its first city; else the longest city; else an abbreviation
    after a comma or a space and before a dash, a comma or six digits."""
    return let(clean_text(text), _location)


def _location(v: Column) -> Column:
    has = lambda name: v.rlike(rf"(?i)\b{re.escape(name)}\b")
    none = F.lit(None).cast("string")

    def state_of(state: str) -> Column:
        cities = [F.when(has(c), F.lit(c.title())) for c, s in vocab.CITY_STATE.items() if s == state]
        return F.struct(F.lit(state).alias("state"), F.coalesce(*cities, none).alias("city"))

    branches = [F.when(has(s), state_of(s)) for s in sorted(vocab.STATES, key=len, reverse=True)]
    branches += [F.when(has(c), F.struct(F.lit(vocab.CITY_STATE[c]).alias("state"), F.lit(c.title()).alias("city"))) for c in sorted(vocab.CITY_STATE, key=len, reverse=True)]
    branches += [F.when(v.rlike(rf"(?:,|\s)\s*{a}\s*(?:-|,|\b\d{{6}}\b)"), F.struct(F.lit(s).alias("state"), none.alias("city"))) for a, s in vocab.STATE_ABBREVIATIONS.items()]
    return F.coalesce(*branches, F.struct(none.alias("state"), none.alias("city")))


def occurrences(text: Column, word: str) -> Column:
    """Non-overlapping, not bound to words."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / len(word))


def phrase_points(text: Column, words: Sequence[str], weight: int) -> Column:
    """Weighted phrases of a text; phrases of several words count double."""

    def points(low: Column) -> Column:
        out = F.lit(0).cast("long")
        for w in words:
            out = out + occurrences(low, w) * (weight * (2 if " " in w else 1))
        return out

    return let(F.lower(F.coalesce(text, F.lit(""))), points)


def category(texts: Sequence[tuple[Column, int]], taxonomy: Taxonomy = vocab.CATEGORIES, none: str = vocab.NO_CATEGORY) -> Column:
    """The category with most weighted phrases; phrases of several words count double; ties go to the first."""

    def points(words: Sequence[str]) -> Column:
        out = F.lit(0)
        for text, weight in texts:
            out = out + phrase_points(text, words, weight)
        return out

    scored = F.array(*[F.struct(points(words).alias("score"), F.lit(-k).alias("place"), F.lit(name).alias("name")) for k, (name, words) in enumerate(taxonomy)])
    return let(F.array_max(scored), lambda best: F.when(best["score"] > 0, best["name"]).otherwise(none))


def acceptable_description(text: Column) -> Column:
    """Cleaned to 500 characters, or null if too short or a banner."""
    banner = lambda s: any_of([F.lower(s).contains(p) for p in vocab.DESCRIPTION_BLOCKLIST])
    return let(clean_text(text, 500), lambda s: F.when((F.length(s) >= 20) & ~banner(s), s))


def normalize_email(raw: Column, junk_domains: Sequence[str] = vocab.JUNK_DOMAINS) -> Column:

    def judged(e: Column) -> Column:
        local, domain = F.substring_index(e, "@", 1), F.substring_index(e, "@", -1)
        good = e.rlike(r"(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}$")
        bad = local.isin(*vocab.JUNK_LOCALS) | domain.isin(*junk_domains) | domain.endswith(vocab.HOSTED_SUFFIX) | e.contains("..")
        return F.when(good & ~bad & ~any_of([e.endswith(x) for x in vocab.IMAGE_SUFFIXES]), e)

    return let(F.lower(F.regexp_replace(F.trim(raw), r"""^[.,;:!?()\[\]{}<>"']+|[.,;:!?()\[\]{}<>"']+$""", "")), judged)


def emails(text: Column, junk_domains: Sequence[str] = vocab.JUNK_DOMAINS) -> Column:
    """Sorted distinct addresses of a text."""
    found = matches(text, "(?iU)" + vocab.EMAIL, 1)
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda m: normalize_email(m, junk_domains)), lambda m: m.isNotNull())))


def normalize_phone(raw: Column, junk: Sequence[str] = vocab.JUNK_PHONES) -> Column:
    """E.164 of an Indian number, or null.  A subset of the public numbering plan: mobile numbers (6 to 9 and nine more
    digits) and geographic ones with a trunk zero or a country code."""
    s = F.trim(F.regexp_replace(raw, r"(?i)(?:tel|phone|mobile|whatsapp)\s*[:.-]?", ""))

    def judged(digits: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(digits, r"^(?:\+91|0091)", ""), "^0", "")
        national = F.when(digits.rlike("^91[6-9][0-9]{9}$"), F.substring(digits, 3, 10)).otherwise(plain)
        foreign = digits.startswith("+") & ~digits.startswith("+91")
        valid = national.rlike("^[6-9][0-9]{9}$") | (digits.rlike(r"^(?:\+91|0091|0)") & national.rlike("^[1-5][0-9]{9}$"))
        out = F.concat(F.lit("+91"), national)
        return F.when(~foreign & valid & ~out.isin(*junk), out)

    return let(F.regexp_replace(s, r"[^0-9+]", ""), judged)


PHONE_IN_TEXT = r"(?<![\d+])(?:(?:\+|00)91[\s().-]*|0)?[1-9](?:[\s().-]{0,2}\d){9}(?!\d)"


def phones(text: Column) -> Column:
    """Sorted distinct numbers of a text."""
    found = F.transform(matches(text, PHONE_IN_TEXT), lambda m: normalize_phone(m))
    return F.array_sort(F.array_distinct(F.filter(found, lambda m: m.isNotNull())))


def inferred_signal(query: Column, signals: Sequence[str] = vocab.SEARCH_SIGNALS) -> Column:
    """The first fingerprint that a search query holds, in either case."""
    return F.coalesce(*[F.when(F.lower(query).contains(s.lower()), F.lit(s)) for s in signals])


def quoted_family(query: Column, signal: Column) -> Column:
    """The first quoted phrase of a query that is not its signal."""
    return F.get(F.filter(matches(query, '"([^"]+)"', 1), lambda x: ~x.eqNullSafe(signal)), F.lit(0))


def rating(value: Column) -> Column:
    """1 for truthy words, 0 for falsy ones, -1 for others, null for blanks."""
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(v == "", None).when(v.isin(*vocab.TRUTHY), 1).when(v.isin(*vocab.FALSY), 0).otherwise(-1)


def lookup(mapping: Mapping[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]


def json_list(text: Column) -> Column:
    """Texts of a JSON list; empty for anything else."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def malformed_json(text: Column) -> Column:
    return F.try_parse_json(F.coalesce(text, F.lit(""))).isNull()


def percent(part: Column, whole: Column) -> Column:
    """One decimal; null where there is nothing to divide by."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), 1)
