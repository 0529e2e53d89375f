from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_trim(c: str) -> Column:
    return F.lower(F.trim(F.col(c)))


def upper_trim(c: str) -> Column:
    return F.upper(F.trim(F.col(c)))


#: Fixed value: the characters behind which the warehouse starts a new word; the apostrophe is none of them.
WORD_ENDS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def capitalised(c: Column) -> Column:
    """Every word with a capital and otherwise small letters; words end at blanks and punctuation."""
    words = F.split(c, f"(?<=[{WORD_ENDS}])")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), "")


def title_words(c: Column, separator: str) -> Column:
    """Separator to blank, then capitalise each word."""
    return capitalised(F.replace(c, F.lit(separator), F.lit(" ")))


def zero_filled(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")
