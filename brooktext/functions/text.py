"""Text functions of the record and token stages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: tokens are separated by single non-word characters (ASCII).
TOKEN_GAP = r"\W"


def prefix_drop(text: Column, n: int) -> Column:
    """``text`` without its first ``n`` characters; shorter text gives ''."""
    return F.substr(text, F.lit(n + 1))


def split_first(text: Column, separator: str) -> tuple[Column, Column]:
    """Text before and after the first separator; NULL after if there is none."""
    place = F.instr(text, separator)
    return F.substring_index(text, separator, 1), F.when(place > 0, F.substr(text, place + len(separator)))


def cut_newline(text: Column) -> Column:
    """``text`` without one newline at its end."""
    return F.when(F.endswith(text, F.lit("\n")), F.left(text, F.length(text) - 1)).otherwise(text)


def field_at(line: Column, position: int = 0, separator: str = ";") -> Column:
    """The field at ``position`` of a delimited line, NULL if there is none."""
    return F.get(F.split(line, separator, position + 2), F.lit(position))


def record_id(sentiment: Column, message: Column) -> Column:
    """A 60-bit id from the content, for streams whose records carry none.

    Taken from MD5, so that it can be recomputed anywhere. Equal records share
    it.
    """
    digest = F.md5(F.concat_ws(",", sentiment, message))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def row_concat(*fields: Column | str) -> Column:
    """Fields joined by nothing, closed by a newline; NULL fields are skipped."""
    return F.concat(F.concat_ws("", *fields), F.lit("\n"))


def tokenize(message: Column) -> Column:
    """Lower-cased word tokens of at least one character.

    Splitting at runs of separators and removing the empty ends gives the same
    tokens as splitting at each one, with no lambda per token.
    """
    return F.array_remove(F.split(F.lower(message), f"{TOKEN_GAP}+"), "")
