"""Text expressions: NULL-safe concatenation, pattern rules, payload and comment templates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query-string names of the campaign payload, in output order.
UTM_PARTS = (
    ("utm_source", "utm_source"),
    ("utm_medium", "utm_medium"),
    ("utm_campaign", "utm_campaign"),
    ("utm_content", "utm_content"),
    ("utm_term", "utm_term"),
    ("utm_from", "from"),
    ("utm_order_page", "utm_orderPage"),
    ("utm_referer", "utm_referer"),
    ("utm_start_page", "utm_startpage"),
    ("utm_ad", "utm_ad"),
    ("utm_device", "utm_device"),
    ("utm_region", "utm_region"),
    ("utm_type", "utm_type"),
)


def concat_skip_null(*parts: Column) -> Column:
    """Concatenation in which NULL counts as the empty text."""
    return F.concat_ws("", *parts)


def matches_any(text: Column, patterns: Iterable[str]) -> Column:
    """Case-insensitive LIKE against any of the patterns."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | text.ilike(pattern)
    return hit


def first_rule(text: Column, rules: Sequence[tuple[Sequence[str], str]], default: Column | None = None) -> Column:
    """Label of the first rule one of whose LIKE patterns fits; else ``default`` (NULL)."""
    chain = None
    for patterns, label in rules:
        fits = matches_any(text, patterns)
        chain = F.when(fits, label) if chain is None else chain.when(fits, label)
    return chain if default is None else chain.otherwise(default)


def normalise(text: Column) -> Column:
    """Lower case with ё written as е."""
    return F.lower(F.regexp_replace(text, "ё", "е"))


def through_marker(text: Column, marker: str) -> Column:
    """The text before ``marker`` plus two characters of it; the first character when it is absent.

    The marker is searched without regard to case.
    """
    return F.left(text, F.locate(marker.lower(), F.lower(text)) + F.lit(1))


def chop_last(text: Column) -> Column:
    """Everything but the last character (cuts a trailing separator)."""
    return F.left(text, F.greatest(F.length(text) - 1, F.lit(0)))


def utm_payload(columns: dict[str, Column]) -> Column:
    """Campaign parts as one query string in a JSON wrapper; empty and NULL parts are left out.

    When the source part is empty the string starts with ``&``; values are not escaped.
    """
    pieces = []
    for position, (name, parameter) in enumerate(UTM_PARTS):
        value = columns[name]
        prefix = ("" if position == 0 else "&") + parameter + "="
        pieces.append(F.when(value != "", F.concat(F.lit(prefix), value)).otherwise(F.lit("")))
    return F.concat(F.lit('{"UTM":"'), *pieces, F.lit('"}'))


def labelled_lines(headline: str, lines: Sequence[tuple[str, Column]], newline: str = "\\n") -> Column:
    """``headline`` and ``label: value`` parts, each closed by a literal backslash-n."""
    parts = [F.lit(headline + newline)]
    for label, value in lines:
        parts += [F.lit(f"{label}: "), value.cast("string"), F.lit(newline)]
    return concat_skip_null(*parts)


def stable_uuid(*key: Column) -> Column:
    """An id in GUID form that depends on the key only, so a recomputed task yields it again."""
    digest = F.sha2(F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in key]), 256)
    spans = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in spans])


def padded_number(number: Column, width: int = 5) -> Column:
    """Digits with leading zeros up to ``width``; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def next_list_number(list_id: Column, suffix: str, width: int = 5) -> Column:
    """Aggregate: zero-padded number after the highest among ids that end with ``suffix``; 1 when none do."""
    leading = F.regexp_extract(list_id, r"^(\d+)", 1).try_cast("long")
    number = F.when(list_id.endswith(suffix), leading)
    return F.concat(padded_number(F.coalesce(F.max(number), F.lit(0)) + 1, width), F.lit(suffix))
