"""Party labels and classes, name fallback."""

from __future__ import annotations

from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column, functions as F

from tributary.functions.cleaning import null_if_blank

# Party codes that often come without a full name (fixed values).
PARTY_NAMES = {
    "DFL": "Democratic-Farmer-Labor",
    "IND": "Independent",
    "LIB": "Libertarian Party",
    "NAT": "Non-affiliated",
    "NNE": "None",
    "OTH": "Other",
    "UNK": "Unknown",
    "WOR": "Working Families",
}
NO_PARTY = "Unknown / other"

# Words that put a label into a class, in order of precedence (fixed values).
CLASS_WORDS = {
    "d": ["democrat"],
    "r": ["republican"],
    "i": ["independent", "green", "libertarian"],
}
OTHER_CLASS = "o"

NO_NAME = "Unknown Committee"

# White space removed around labels (fixed values).
WHITE_SPACE = (" \t\n\r\f\v\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000\ufeff")


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def party_label(full: Column, code: Column) -> Column:
    """Full name, else the known name of the code, else the code, else a fixed label."""
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(PARTY_NAMES.items())])
    upper = null_if_blank(F.upper(trimmed(code)))
    return F.coalesce(
        null_if_blank(trimmed(full)), F.element_at(names, upper), upper, F.lit(NO_PARTY)
    )


def party_class(label: Column) -> Column:
    """One letter, by the first class that has a word in the label."""
    low = F.lower(label)
    chosen = None
    for letter, words in CLASS_WORDS.items():
        found = reduce(or_, [F.contains(low, F.lit(word)) for word in words])
        chosen = F.when(found, letter) if chosen is None else chosen.when(found, letter)
    return chosen.otherwise(OTHER_CLASS)


def name_or_id(name: Column, entity_id: Column) -> Column:
    return F.coalesce(null_if_blank(name), entity_id)
