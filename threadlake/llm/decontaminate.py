"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Text is normalised byte by byte (A-Z lower-cased, every other ASCII character that
is no letter or digit becomes a space), so that places in the normalised text are
places in the original, and scanned once.
"""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import map_columns, text_or_empty

# An automaton of this many bytes of windows takes under 1 GB in a worker.
AUTOMATON_BYTES = 8_000_000


def _normal_byte(byte: int) -> int:
    char = chr(byte)
    if "A" <= char <= "Z":
        return ord(char.lower())
    return byte if byte > 127 or "a" <= char <= "z" or "0" <= char <= "9" else ord(" ")


NORMAL = bytes(_normal_byte(byte) for byte in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


def windows_of(text: str | None, size: int) -> set[bytes]:
    """The windows of ``size`` words; an item of fewer words, but not none, is one."""
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def slices(items: Iterable[tuple], size: int, most: int = AUTOMATON_BYTES) -> list[dict]:
    """Windows and the items they belong to, in dictionaries of at most ``most`` bytes."""
    parts: list[dict] = [{}]
    used = 0
    for item, text in items:
        for window in sorted(windows_of(text, size)):
            if used > most:
                parts.append({})
                used = 0
            if window not in parts[-1]:
                used += len(window)
                parts[-1][window] = []
            parts[-1][window].append(item)
    return parts


def automaton_of(windows: dict):
    automaton = ahocorasick.Automaton()
    for window, items in windows.items():
        # A space on both sides keeps a match to whole words.
        key = f" {window.decode('latin-1')} "
        automaton.add_word(key, (window.count(b" ") + 1, items))
    if windows:
        automaton.make_automaton()
    return automaton


class Scanner:
    """Word counts and hit words of texts, by one automaton."""

    def __init__(self, windows: dict):
        self.automaton = automaton_of(windows) if windows else None

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, hit runs of words (first, end), and the items found."""
        words = words_of(text)
        n = len(words)
        if not n or self.automaton is None:
            return n, [], set()
        flat = b" ".join(words)
        runs, items, spaces = [], set(), None
        for end, (length, found) in self.automaton.iter(f" {flat.decode('latin-1')} "):
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(b" " + flat + b" ", np.uint8) == 32)
            last = int(np.searchsorted(spaces, end))
            runs.append((last - length, last))
            items.update(found)
        return n, merged(runs), items


def merged(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted runs without overlaps."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as character offsets (start, end) of the original text."""
    if not runs:
        return []
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    letter = np.frombuffer(raw.tobytes().translate(NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.r_[False, letter, False]))
    starts, ends = edges[::2], edges[1::2]
    chars = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return [(int(chars[starts[a]]), int(chars[ends[b - 1]])) for a, b in runs]


RUNS = "array<struct<start: long, end: long>>"


def scan_documents(
    df: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: words, hit words, hit items, hit spans in the original text.

    Returns ``doc_id, n_words, n_hit, items`` (sorted as strings), ``spans`` (character
    offsets of the original text) and the columns named in ``keep``. A word is hit if it
    lies inside any occurrence of a window. A null or empty text has no words; a null
    item id counts as the item ``null``; repeated rows are judged each; an empty
    benchmark hits nothing.

    The benchmark is a fixed test set and does not grow with the documents. Its windows
    are broadcast; where they exceed ``AUTOMATON_BYTES`` they are cut into slices,
    each scanned by workers of its own, and the hits of all slices are joined. No shuffle.
    """
    spark = df.sparkSession
    chosen = benchmark.select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("null")),
        F.col(item_text_column).cast("string"),
    )
    parts = slices(map(tuple, chosen.toLocalIterator()), window)
    kind = df.schema[id_column].dataType.simpleString()
    extra = "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in keep)
    rows = df.select(
        F.col(id_column).alias("doc_id"),
        text_or_empty(text_column).alias("_text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(RUNS).alias("runs"),
        F.array().cast("array<string>").alias("items"),
        *keep,
    )
    schema = f"doc_id {kind}, _text string, n_words long, runs {RUNS}, items array<string>{extra}"
    for part in parts:
        rows = _scan(rows, spark.sparkContext.broadcast(part), schema)
    return _finish(rows, f"doc_id {kind}, n_words long, n_hit long, items array<string>, spans {RUNS}{extra}")


def _scan(rows: DataFrame, shared, schema: str) -> DataFrame:
    def body():
        scanner = Scanner(shared.value)

        def one(batch: pa.RecordBatch) -> list:
            counts, all_runs, all_items = [], [], []
            texts = batch.column(1)
            before = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())
            for text, (runs, items) in zip(texts, before):
                n, more, found = scanner.scan(text.as_py())
                counts.append(n)
                runs = [(r["start"], r["end"]) for r in runs]
                all_runs.append([{"start": a, "end": b} for a, b in merged(runs + more)])
                all_items.append(sorted(found.union(items)))
            return [
                batch.column(0),
                texts,
                pa.array(counts, pa.int64()),
                pa.array(all_runs, _RUNS),
                pa.array(all_items, pa.list_(pa.string())),
                *batch.columns[5:],
            ]

        return one

    return map_columns(rows, schema, body)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _finish(rows: DataFrame, schema: str) -> DataFrame:
    def body():
        def one(batch: pa.RecordBatch) -> list:
            hits, spans = [], []
            for i, runs in enumerate(batch.column(3).to_pylist()):
                pairs = [(r["start"], r["end"]) for r in runs]
                hits.append(sum(b - a for a, b in pairs))
                found = original_spans(batch.column(1)[i].as_py(), pairs) if pairs else []
                spans.append([{"start": a, "end": b} for a, b in found])
            return [
                batch.column(0),
                batch.column(2),
                pa.array(hits, pa.int64()),
                batch.column(4),
                pa.array(spans, _RUNS),
                *batch.columns[5:],
            ]

        return one

    return map_columns(rows, schema, body)


def report(scanned: DataFrame) -> DataFrame:
    """The digest of ``scan_documents``: counts, items found, and whether anything was hit."""
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )



def keep_clean(
    df: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The rows of ``df``, with all their columns, in which no window occurs."""
    context = df.sparkSession.sparkContext
    chosen = benchmark.select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("null")), F.col(item_text_column).cast("string")
    )
    at = df.columns.index(text_column)
    rows = df
    for part in slices(map(tuple, chosen.toLocalIterator()), window):
        rows = rows.mapInArrow(_clean_batches(context.broadcast(part), at), df.schema)
    return rows


def _clean_batches(shared, at: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for batch in batches:
            clean = [not scanner.scan(text.as_py())[1] for text in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
