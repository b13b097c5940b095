"""Masks for personal data.

The default masks keep the first letters of words and the ends of phone
numbers.  They are known to be weak: one-word, double-spaced and non-ASCII
names pass the name-pair mask, values without ``@`` pass the mail mask, phone
numbers with blanks pass the phone mask, and an unsalted digest of a short
number can be reversed by trying all numbers.  ``hidden`` is the strict way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mask patterns and replacements.
NAME_PAIR = (r"(\w)\w+\s(\w)\w+", "$1*** $2***")
NAME_WORD = (r"(\w)\w+", "$1***")
EMAIL = (r"(^.)(.*)(@.*)", "$1*******$3")
PHONE = (r"(\+?\d{2})\d+(\d{3})", "$1*******$2")


def masked(value: Column, mask: tuple[str, str]) -> Column:
    pattern, replacement = mask
    return F.regexp_replace(value, pattern, replacement)


def digest(value: Column) -> Column:
    return F.md5(value)


def hidden(value: Column, salt: str) -> Column:
    """Salted digest of the whole value: nothing of it stays readable."""
    return F.sha2(F.concat(F.lit(salt), value), 256)
