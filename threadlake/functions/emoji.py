"""Emoji as the words of their names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlake.functions.lookup import literal_lookup

# The Unicode blocks that hold symbols shown as emoji.
_BLOCKS = ((0x2600, 0x27BF), (0x1F300, 0x1F64F), (0x1F680, 0x1F6FF), (0x1F900, 0x1FAFF))


@cache
def emoji_names() -> Mapping[str, str]:
    """Each symbol of the emoji blocks with its Unicode name in lower case."""
    chars = (chr(code) for low, high in _BLOCKS for code in range(low, high + 1))
    return {char: unicodedata.name(char).lower() for char in chars if unicodedata.name(char, "")}


def _class_of(chars: set[str]) -> str:
    """A character class in ranges."""
    codes, parts = sorted(map(ord, chars)), []
    for code in codes:
        if parts and parts[-1][1] == code - 1:
            parts[-1][1] = code
        else:
            parts.append([code, code])
    return "[" + "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in parts) + "]"


def spell_emoji(text: Column, names: Mapping[str, str]) -> Column:
    """Each emoji of ``names`` becomes its name with a blank on either side.

    An emoji may have several characters; the longest that fits counts. A text without
    any is left as it is after one look for their first characters.
    """
    if not names:
        return text
    first = _class_of({emoji[0] for emoji in names})
    long = sorted((re.escape(e) for e in names if len(e) > 1), key=len, reverse=True)
    single = {e for e in names if len(e) == 1}
    pattern = "(" + "|".join([*long, *([_class_of(single)] if single else [])]) + ")"
    name_of = literal_lookup(dict(names), "string")
    pieces = F.split(text, pattern, -1)
    spelled = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)),
        lambda emoji: F.concat(F.lit(" "), name_of(emoji), F.lit(" ")),
    )
    joined = F.array_join(
        F.zip_with(pieces, spelled, lambda piece, name: F.concat(piece, F.coalesce(name, F.lit("")))), ""
    )
    return F.when(text.rlike(first), joined).otherwise(text)
