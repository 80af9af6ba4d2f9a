"""Small word tables as constants of the plan, and names within expressions."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word table is configuration, not data: it becomes part of every task.
MAX_TABLE_WORDS = 200_000


def literal_lookup(
    table: Mapping[str, object], kind: str = "double"
) -> Callable[[Column], Column]:
    """A function that maps a word column to the word's value, or null.

    The table is one constant of the plan: an array of small maps, picked by
    the CRC of the word, so that a look-up scans a handful of entries whatever
    the table's size. It can be used inside ``transform`` and ``aggregate``,
    which a join cannot, and so needs no shuffle of exploded words.
    """
    if len(table) > MAX_TABLE_WORDS:
        raise ValueError(f"word table of {len(table)} entries; at most {MAX_TABLE_WORDS}")
    count = max(1, len(table) // 4)
    buckets: list[dict[str, object]] = [{} for _ in range(count)]
    for word, value in table.items():
        buckets[zlib.crc32(word.encode("utf-8")) % count][word] = value
    constant = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{kind}>>")

    def find(word: Column) -> Column:
        slot = (F.crc32(word.cast("binary")) % F.lit(count) + F.lit(1)).cast("int")
        return F.element_at(F.element_at(constant, slot), word)

    return find


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often it is used.

    A column added for the purpose would not do: a filter on the result may be
    pushed below it, and the optimizer then writes its whole expression into
    every use, also into those inside a loop over an array.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
