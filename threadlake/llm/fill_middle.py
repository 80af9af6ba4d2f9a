"""Fill-in-the-middle: documents cut at two ranks found in an indexable skip list.

The units of a text (lines, with the line feed that ends them) are the links of a skip
list's lowest lane. Every lane above holds about a quarter of the nodes below, and a link
of any lane carries how many units and how many code points it passes. From the highest
lane down, links are followed as long as the units passed do not exceed the wanted rank,
so a rank is reached exactly in a number of steps that grows with the logarithm of the
units, and the code points passed on the way are the place of the cut.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import map_columns, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

# A node is in the next lane if the low-discrepancy sequence of this step falls below a
# quarter: lanes thin out evenly whatever the text, and a lane is left after a few links.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
QUARTER = np.uint64(1 << 62)


def line_widths(text: str) -> np.ndarray:
    """Code points of each line of ``text``; a line ends with its line feed or the text."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.flatnonzero(points == 10) + 1
    if len(points) and (not len(ends) or ends[-1] != len(points)):
        ends = np.append(ends, len(points))
    return np.diff(ends, prepend=0)


@dataclass(frozen=True)
class Lane:
    """Links between neighbouring nodes of a lane.

    ``units`` and ``points`` are what a link passes; ``below`` is the place of each node
    in the lane below.
    """

    units: np.ndarray
    points: np.ndarray
    below: np.ndarray


class SkipList:
    """Units by rank; node 0 is the start and in every lane."""

    def __init__(self, widths: np.ndarray):
        self.size = len(widths)
        lane = Lane(np.ones(self.size, np.int64), widths.astype(np.int64), np.arange(self.size + 1))
        self.lanes = [lane]
        while len(lane.units) > 4:
            place = np.arange(len(lane.units) + 1, dtype=np.uint64)
            chosen = np.flatnonzero(place * GOLDEN < QUARTER)
            # The link behind a lane's last node leads nowhere and is left out.
            last = chosen[-1]
            lane = Lane(
                np.add.reduceat(lane.units[:last], chosen[:-1]) if len(chosen) > 1 else lane.units[:0],
                np.add.reduceat(lane.points[:last], chosen[:-1]) if len(chosen) > 1 else lane.points[:0],
                chosen,
            )
            self.lanes.append(lane)

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        if not 0 <= rank <= self.size:
            raise IndexError(rank)
        units = points = place = 0
        for lane in reversed(self.lanes):
            while place < len(lane.units) and units + lane.units[place] <= rank:
                units += lane.units[place]
                points += lane.points[place]
                place += 1
            place = lane.below[place]
        return int(points)


@dataclass(frozen=True)
class Rates:
    """``cut`` of 100 documents are cut, ``spm`` of 100 of those start with their suffix."""

    cut: int = 100
    spm: int = 50


def formatted(text: str, draws: tuple[int, int, int, int], rates: Rates) -> tuple:
    """``n, form, prefix code points, middle code points, output`` of one text."""
    units = SkipList(line_widths(text))
    n = units.size
    first, second, third, fourth = draws
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or third % 100 >= rates.cut:
        return n, PLAIN, None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    start, end = units.points_before(low), units.points_before(high)
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if fourth % 100 < rates.spm:
        return n, SPM, start, end - start, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, start, end - start, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def draws_of(digest: str) -> tuple[int, int, int, int]:
    """The first four groups of eight hex digits as unsigned integers."""
    return tuple(int(digest[at : at + 8], 16) for at in (0, 8, 16, 24))


def _format_batches(rates: Rates) -> Callable[[], Callable[[pa.RecordBatch], list]]:
    def one_task():
        def one(batch: pa.RecordBatch) -> list:
            ids, texts, digests = batch.columns
            rows = [formatted(t.as_py(), draws_of(d.as_py()), rates) for t, d in zip(texts, digests)]
            n, form, prefix, middle, output = zip(*rows)
            return [
                ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()), pa.array(output, pa.string()),
            ]

        return one

    return one_task


def fill_in_middle(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = 7, rates: Rates = Rates()
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: a row for every row, no shuffle.

    The draws of a document come from the SHA-256 of ``seed:doc_id``, so they are the same in
    every run and whatever the partitions are. A null text is empty, and an empty text is
    plain with no units; a null id is drawn as if it were no text after the colon. Repeated
    rows give repeated rows, other columns play no part, and an empty table gives none.
    """
    rows = df.select(
        F.col(id_column).alias("doc_id"),
        text_or_empty(text_column).alias("text"),
        F.sha2(F.concat(F.lit(f"{seed}:"), text_or_empty(id_column)), 256).alias("digest"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_columns(rows, schema, _format_batches(rates))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from; no part of it can hold a mark."""
    parts = F.split(output, "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE))))
    return (
        F.when(form == PSM, F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == SPM, F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(output)
    )


def digests(made: DataFrame) -> DataFrame:
    """What ``fill_in_middle`` made, with digests of the output and of the text rebuilt from it."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
