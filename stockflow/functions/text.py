"""Text columns: trimming, title case, splitting of item names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a text strip removes at either end.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# artist/title separators, in the order they are tried.
NAME_SEPARATORS = (" - ", " \u2013 ", " \u2014 ")

_BREAK = "\u0001 "


def strip(c: Column) -> Column:
    """Without whitespace at either end; plain text only needs its spaces taken off."""
    return F.when(c.rlike(r"[^\x20-\x7e]"), F.btrim(c, F.lit(WHITESPACE))).otherwise(F.trim(c))


def title_case(c: Column) -> Column:
    """Trimmed, with a capital after every character that is not a letter.

    `initcap` only starts a word after a space, so a marked space is put after the other
    separators first and taken out again afterwards.
    """
    marked = F.regexp_replace(strip(c), r"([^\p{Lu}\p{Ll}\p{Lt} ])", "$1" + _BREAK)
    return F.replace(F.initcap(marked), F.lit(_BREAK), F.lit(""))


def split_name(name: Column) -> tuple[Column, Column]:
    """(artist, title) of an item name; without a separator all of it is the title."""
    name = F.coalesce(name, F.lit(""))
    artist, title = F.lit(""), name
    for sep in reversed(NAME_SEPARATORS):
        at = F.instr(name, sep)
        found = at > 0
        artist = F.when(found, F.substring_index(name, sep, 1)).otherwise(artist)
        title = F.when(found, F.substr(name, at + F.lit(len(sep)))).otherwise(title)
    return strip(artist), strip(title)
