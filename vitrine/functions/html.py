"""HTML helpers as Catalyst expressions (regex on elements that cannot nest).

All patterns are Java regular expressions evaluated inside whole-stage
codegen; nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.operators.elements import NAMED

REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _not_empty(text: Column) -> Column:
    """The text, NULL if empty; computed once."""
    return F.try_element_at(F.filter(F.array(text), lambda x: x != ""), F.lit(1))


def unescape(c: Column | str) -> Column:
    """Character references, named or numeric, as characters; unknown ones stay as they are.

    Each distinct reference of a text is decoded once and replaced everywhere. Decoded ampersands stand aside
    meanwhile (as U+FFFF, which no text holds), so they start no new reference.
    """
    # one literal, folded to a map once
    names = F.str_to_map(F.lit(" ".join(f"{k}={v}" for k, v in NAMED.items())), F.lit(" "), F.lit("="))

    def char(code: Column) -> Column:
        ok = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))

    def value(ref: Column) -> Column:
        whole = F.concat(F.lit("&"), ref, F.lit(";"))
        decimal = char(F.conv(F.substring(ref, F.lit(2), F.length(ref)), 10, 10).cast("bigint"))
        hexa = char(F.conv(F.substring(ref, F.lit(3), F.length(ref)), 16, 10).cast("bigint"))
        numeric = F.when(ref.rlike("^#[xX]"), hexa).when(ref.startswith("#"), decimal)
        return F.coalesce(F.try_element_at(names, ref), numeric, whole)

    def replaced(text: Column, ref: Column) -> Column:
        return F.replace(text, F.concat(F.lit("&"), ref, F.lit(";")), F.regexp_replace(value(ref), "^&$", "\uffff"))

    text = _c(c)
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)))
    return F.when(text.contains("&"), F.translate(F.aggregate(refs, text, replaced), "\uffff", "&")).otherwise(text)


def strip_tags(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), r"<[^>]*>", "")


def text_of(c: Column | str) -> Column:
    """Visible text of an HTML fragment: tags removed, entities decoded, trimmed.

    Empty text becomes NULL.
    """
    return _not_empty(F.btrim(unescape(strip_tags(c)), F.lit(" \t\n\u000b\f\r\u00a0")))


def _attr_match(attr: str, value: str, mode: str) -> str:
    if mode == "exact":
        return rf'\b{attr}="{value}"'
    if mode == "token":  # one class token equal to value
        return rf'\b{attr}="(?:[^"]*\s)?{value}(?:\s[^"]*)?"'
    if mode == "within":  # value anywhere in the attribute
        return rf'\b{attr}="[^"]*{value}[^"]*"'
    if mode == "prefix":  # one class token starting with value
        return rf'\b{attr}="(?:[^"]*\s)?{value}[^"]*"'
    raise ValueError(mode)


def start_tag_pattern(tag: str, attr: str | None = None, value: str | None = None, mode: str = "exact") -> str:
    """Regex of one start tag, optionally with an attribute condition."""
    cond = f"(?=[^>]*{_attr_match(attr, value, mode)})" if attr else ""
    return rf"<{tag}\b{cond}[^>]*>"


def element_pattern(tag: str, attr: str | None = None, value: str | None = None, mode: str = "exact") -> str:
    """Regex of a whole element whose content holds no element of the same tag.

    Group 1 is the inner HTML.
    """
    return rf"(?s){start_tag_pattern(tag, attr, value, mode)}(.*?)</{tag}>"


def inner(html: Column | str, tag: str, attr: str | None = None, value: str | None = None, mode: str = "exact") -> Column:
    """Inner HTML of the first matching element; NULL when there is none or it is empty."""
    got = F.regexp_extract(_c(html), element_pattern(tag, attr, value, mode), 1)
    return F.when(got != "", got)


def start_tag(html: Column | str, tag: str, attr: str | None = None, value: str | None = None, mode: str = "exact") -> Column:
    """Text of the first matching start tag; NULL when there is none."""
    pat = start_tag_pattern(tag, attr, value, mode)
    got = F.regexp_extract(_c(html), f"({pat})", 1)
    return F.when(got != "", got)


def attr(tag_text: Column | str, name: str) -> Column:
    """Value of attribute ``name`` in a start tag; NULL when absent."""
    pat = rf'\s{name}="([^"]*)"'
    return unescape(_not_empty(F.regexp_extract(_c(tag_text), pat, 1)))


def region(html: Column | str, tag: str, attr_name: str | None, value: str | None, mode: str = "exact") -> Column:
    """The page from the first matching start tag on (the area a scraper reads)."""
    pat = rf"(?s)({start_tag_pattern(tag, attr_name, value, mode)}.*)"
    got = F.regexp_extract(_c(html), pat, 1)
    return F.when(got != "", got)
