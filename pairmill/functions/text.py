"""Text columns: blankness, identity, prompt rendering, code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairmill.config import ChatTemplate

# The characters Python's str.strip() removes, and a Java pattern for any other one.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"


def nonblank(text: Column) -> Column:
    """True when something is left after stripping; null counts as blank."""
    return F.coalesce(text.rlike(NOT_BLANK), F.lit(False))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def content_hash(instruction: Column, response: Column) -> Column:
    """SHA-256, in hex, of the unstripped pair joined by a NUL character."""
    return F.sha2(F.concat(instruction, F.lit("\0"), response), 256)


def render_prompt(instruction: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    return F.concat(F.lit(template.prefix), instruction, F.lit(template.suffix))


def codepoints(text: Column) -> Column:
    """Unicode code points of the whole text as array<bigint>."""
    # Splitting an empty text would give one empty character.
    characters = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))
    return F.transform(characters, lambda c: F.ascii(c).cast("bigint"))
