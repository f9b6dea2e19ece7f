"""Tokenizing and text analysis."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters folded one to one, and those that fold to two letters.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
FOLDED = "aaaaaaceeeeiiiinoooooouuuuyy"
DIGRAPHS = {"æ": "ae", "œ": "oe", "ß": "ss"}

NOT_WORD = "[^\\p{L}\\p{Nd}]+"


def tokenize_sql(text: str) -> str:
    return f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{Nd}}]+'), w -> octet_length(w) >= 2)"


def tokenize(text: str | Column) -> Column:
    """Lower-case runs of letters and decimal digits of two or more bytes."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(column), NOT_WORD), lambda w: F.octet_length(w) >= 2)


def fold_accents(text: Column) -> Column:
    """Replace the covered accented Latin letters by ASCII ones."""
    for letter, pair in DIGRAPHS.items():
        text = F.replace(text, F.lit(letter), F.lit(pair))
    return F.translate(text, ACCENTED, FOLDED)


def analyze_text(text: str | Column) -> Column:
    """Search tokens: lower case, accents folded, every non-empty run of letters and digits."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(fold_accents(F.lower(column)), NOT_WORD), lambda w: w != "")


def analyze_literal(text: str) -> list[str]:
    """The tokens that :func:`analyze_text` makes of a text, for parameters."""
    text = text.lower()
    for letter, pair in DIGRAPHS.items():
        text = text.replace(letter, pair)
    text = text.translate(str.maketrans(ACCENTED, FOLDED))
    return "".join(c if unicodedata.category(c)[0] == "L" or c.isdecimal() else " " for c in text).split()
