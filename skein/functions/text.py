"""Scalar text functions: Column in, Column out, no UDF.  Absent text is the empty string."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.split`` sees it, as a character class of Java and RE2.
WS = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once: a lambda variable keeps large expressions small."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def bind_sql(body: str, **values: Column) -> Column:
    """A SQL expression over ``r.<name>`` with every value computed once; far fewer calls to build than ``bind``."""
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    return F.get(F.call_function("transform", F.array(row), F.expr(f"r -> {body}")), F.lit(0))


def norm(c: Column) -> Column:
    """Runs of white space become one space; ends trimmed; null is ''."""
    return F.trim(F.regexp_replace(text_of(c), WS + "+", " "))


def tok(c: Column) -> Column:
    """ASCII letters and digits only."""
    return F.regexp_replace(text_of(c), "[^A-Za-z0-9]", "")


def signature(c: Column) -> Column:
    """Lower-cased ASCII letters and digits."""
    return F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]", "")


def slug(c: Column) -> Column:
    """Lower case, other characters as single hyphens, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def escape_html(c: Column) -> Column:
    """P7."""
    return F.replace(F.replace(F.replace(text_of(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def basename(c: Column) -> Column:
    """Last path component."""
    return F.substring_index(text_of(c), "/", -1)


def image_id(href: Column) -> Column:
    """File name; else the whole reference; else 'image'."""
    h = text_of(href)
    return F.when(basename(h) != "", basename(h)).when(h != "", h).otherwise(F.lit("image"))


def image_token(href: Column) -> Column:
    """Inline placeholder of an image."""
    return F.concat(F.lit("[IMAGE: "), image_id(href), F.lit("]"))


def window(text: Column, a: Column, b: Column) -> Column:
    """Normalised slice [a, b) with an ellipsis where something was cut off."""
    cut = norm(F.substring(text, a + 1, F.greatest(b - a, F.lit(0))))
    dots = F.lit("…")
    return F.concat(F.when(a > 0, dots).otherwise(F.lit("")), cut, F.when(b < F.char_length(text), dots).otherwise(F.lit("")))


def is_reserved(c: Column) -> Column:
    """Ends in '[reserved]' but for trailing full stops."""
    return F.lower(F.regexp_replace(norm(c), r"\.+$", "")).endswith("[reserved]")


def url_for(template: Column, number: Column) -> Column:
    """P21."""
    return F.replace(template, F.lit("{num}"), number)


def cache_key(provider: Column, prompt_version: str, stage: str, payload: Column) -> Column:
    """First 16 hex digits of the SHA-1 of what a cached answer depends on."""
    return F.substring(F.sha1(F.concat_ws("|", provider, F.lit(prompt_version), F.lit(stage), payload)), 1, 16)


def first_evidence(mentions: Column) -> Column:
    """Evidence of the first mention, '' without any."""
    return F.coalesce(F.get(mentions, F.lit(0))["evidence"], F.lit(""))
