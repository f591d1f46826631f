"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: every character that counts as white space at either end of a text -------
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ------------------------------------------------------------------------------------------
TAG = r"<[^>]+>"
OUTSIDE = r"[^\p{L}\p{N}_]"
WORD = r"[\p{L}\p{N}_]+"


def normal_key(c: Column | str) -> Column:
    """Lower case without blanks at the ends: the join form of a commodity name."""
    return F.trim(F.lower(F.col(c) if isinstance(c, str) else c))


def strip_space(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def strip_tags(c: Column) -> Column:
    """Text without tags; a text without any ``<`` skips the pattern."""
    return strip_space(F.when(c.contains("<"), F.regexp_replace(c, TAG, "")).otherwise(c))


def not_blank(c: Column, longer_than: int = 0) -> Column:
    """True only for a present text whose trimmed length exceeds ``longer_than``."""
    return c.isNotNull() & (F.length(F.trim(c)) > longer_than)


def mentions(lowered: Column, keyword: str) -> Column:
    """Case-insensitive substring test over a whole text already in lower case."""
    return lowered.contains(keyword.lower())


def mentions_word(lowered: Column, keyword: str) -> Column:
    """As :func:`mentions`, but no letter or digit of any script may touch the keyword."""
    return lowered.rlike(rf"(\A|{OUTSIDE})\Q{keyword.lower()}\E({OUTSIDE}|\z)")


def underscored(c: Column) -> Column:
    return F.translate(c, " ", "_")


def article_id(link: Column, title: Column, published: Column) -> Column:
    """The link, or a digest of title and publication text when there is none."""
    absent = link.isNull() | (link == "")
    digest = F.md5(F.concat(F.coalesce(title, F.lit("")), F.coalesce(published, F.lit(""))))
    return F.when(absent, digest).otherwise(link)
