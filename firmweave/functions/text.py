"""String clean-up and match keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when text is stripped or split.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as regular expressions: Java's \s, made Unicode-aware by (?U), lacks \x1c-\x1f.
WS = r"\s\x1c-\x1f"
UNICODE = "(?U)"

# Texts that stand for a missing value.
NULL_TOKENS = ("nan", "none", "null")


def strip(c: Column) -> Column:
    """Drop white space of every kind from both ends. ``trim`` alone drops spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


def name_clean(c: Column) -> Column:
    return strip(F.coalesce(c.cast("string"), F.lit("")))


def address_clean(c: Column) -> Column:
    """Strip, and squeeze each inner run of white space to one space."""
    return F.regexp_replace(name_clean(c), f"{UNICODE}[{WS}]+", " ")


def match_key(c: Column) -> Column:
    """Lower case, letters a-z and digits only; NULL gives the empty key."""
    return F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "[^a-z0-9]+", "")


def corporate_id(name_key: Column, address_key: Column) -> Column:
    """First 16 hex digits of SHA-256 over ``<name key>_<address key>``."""
    return F.substring(F.sha2(F.concat(name_key, F.lit("_"), address_key), 256), 1, 16)


def null_tokens(c: Column) -> Column:
    """NULL for blank text and for a lower-case null token, else the stripped text."""
    s = strip(c)
    return F.when((s != "") & ~s.isin(*NULL_TOKENS), s)


def is_missing_text(s: Column) -> Column:
    """True for blank text and null tokens in any letter case. Expects non-NULL text."""
    return (s == "") | F.lower(s).isin(*NULL_TOKENS)
