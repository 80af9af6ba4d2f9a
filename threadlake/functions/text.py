"""Text cleaning and tokenising."""

from __future__ import annotations

import html
import html.entities
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlake.functions.lookup import let, literal_lookup

# The entities that make up nearly all of them in user-written
# HTML. "&amp;" stays last, so that "&amp;lt;" becomes "&lt;" and no more.
_PLAIN_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#x27;", "'"),
    ("&#x2F;", "/"),
    ("&#x2f;", "/"),
    ("&#39;", "'"),
    ("&amp;", "&"),
]

# An ampersand that may start an entity outside the list above.
_OTHER_ENTITY = r"&(?!(?:lt|gt|quot|#x27|#x2[Ff]|#39|amp);)[^\s<&;]"

_TAG = r"<[^>]+>"
# Unicode white space other than the plain blank.
_WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_WORD = r"[\p{L}\p{N}_]{2,}"


# A character reference: decimal, hexadecimal or a name of up to 32 characters.
_REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_LAST_CODE_POINT = 0x10FFFF
_REPLACEMENT = "\ufffd"


@cache
def _odd_code_points() -> dict[str, str]:
    """Numbers that do not stand for their own character, with what they stand for."""
    candidates = [*range(0xA0), *range(0xFDD0, 0xFDF0), 0xFEFF]
    for plane in range(0, _LAST_CODE_POINT + 1, 0x10000):
        candidates += [plane + 0xFFFE, plane + 0xFFFF]
    return {str(number): html.unescape(f"&#{number};") for number in candidates}


def _numbered(name: Column) -> Column:
    """The character of ``#65;`` or ``#x41;``."""
    digits = F.regexp_replace(name, "^#[xX]?0*|;$", "")
    base = F.when(name.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10))
    number = (
        F.when(digits == "", 0)
        .when(F.length(digits) > 7, _LAST_CODE_POINT + 1)
        .otherwise(base.cast("int"))
    )

    def character(code: Column) -> Column:
        outside = (code > _LAST_CODE_POINT) | code.between(0xD800, 0xDFFF)
        own = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        odd = literal_lookup(_odd_code_points(), "string")(code.cast("string"))
        return F.coalesce(odd, F.when(outside, _REPLACEMENT).otherwise(own))

    return let(number, character)


def _named(name: Column) -> Column:
    """The characters of ``amp;``, or of the longest start that is a name."""
    known = literal_lookup(html.entities.html5, "string")
    lengths = F.when(F.length(name) > 1, F.sequence(F.length(name), F.lit(2), F.lit(-1)))
    longest = F.get(F.filter(lengths, lambda n: known(F.substring(name, 1, n)).isNotNull()), F.lit(0))

    def split_at(length: Column) -> Column:
        return F.concat(
            known(F.substring(name, 1, length)), F.substring(name, length + 1, F.length(name))
        )

    return F.coalesce(let(longest, split_at), F.concat(F.lit("&"), name))


def _decode_all(text: Column) -> Column:
    """Every reference of ``text`` in turn: cut the text at them and put it together again."""
    pieces = F.split(text, _REFERENCE, -1)
    names = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1))
    decoded = F.transform(
        names, lambda name: F.when(name.startswith("#"), _numbered(name)).otherwise(_named(name))
    )
    joined = F.zip_with(
        pieces, decoded, lambda piece, part: F.concat(piece, F.coalesce(part, F.lit("")))
    )
    return F.array_join(joined, "")


def strip_tags(text: Column) -> Column:
    """Each tag becomes one space."""
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, _TAG, " ")).otherwise(text)


def decode_entities(text: Column) -> Column:
    """HTML character references decoded in one pass, as ``html.unescape`` does.

    The common ones are replaced outright; only a text that may hold another
    one is cut up.
    """
    common = reduce(
        lambda done, pair: F.replace(done, F.lit(pair[0]), F.lit(pair[1])), _PLAIN_ENTITIES, text
    )
    return (
        F.when(~F.contains(text, F.lit("&")), text)
        .when(text.rlike(_OTHER_ENTITY), _decode_all(text))
        .otherwise(common)
    )


def squeeze_spaces(text: Column) -> Column:
    """Runs of Unicode white space become one blank; none at the ends."""
    # Translating first leaves the pattern two plain blanks to look for, which is
    # far cheaper than a class of twenty code points.
    blanks = F.translate(text, _WHITE_SPACE, " " * len(_WHITE_SPACE))
    return F.trim(F.regexp_replace(blanks, "  +", " "))


def clean_html(text: Column) -> Column:
    """Tags out, entities decoded, white space squeezed; null becomes empty."""
    return squeeze_spaces(decode_entities(strip_tags(F.coalesce(text, F.lit("")))))


def word_tokens(text: Column) -> Column:
    """Lower-case words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0)
    )


def csv_terms(text: Column) -> Column:
    """The trimmed parts of a comma-separated string."""
    return F.transform(F.split(text, ","), lambda part: F.trim(part))
