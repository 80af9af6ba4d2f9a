"""Best-fit packing: few-document patterns fitted to the length histogram.

Only the histogram (at most ``capacity`` counts) reaches the driver. Patterns of one to
four lengths are enumerated from it, their repeat counts fitted by non-negative
least squares and rounded, and what is left is packed by best fit, a run of equal
sequences at a time. The plan is a small table; every piece finds its place in it by
its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Callable, Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadlake.llm.common import map_columns, text_or_empty, written
from threadlake.llm.token_counts import MergeTable, in_batches

CAPACITY = 2048
CACHE_ENTRIES = 700_000
PLAIN_SIGNS = ".,;:!?"
# Fixed value: how the vocabulary's file splits a lower-cased text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Separators for str.split that the vocabulary's file does not take for white space.
_ODD_SPACE = regex.compile("[\x1c-\x1f]")


class _Cache(dict):
    """Ids by word; collects the words that were looked up and are not there yet."""

    def __init__(self):
        super().__init__()
        self.missed: set[str] = set()

    def __missing__(self, word: str) -> None:
        self.missed.add(word)


def id_encoder(path: str, cache_entries: int = CACHE_ENTRIES) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their token ids, as little-endian unsigned 32-bit bytes.

    No token crosses white space, so ids are kept for each run of other characters.
    Runs of Latin-1 characters, which composing leaves as they are, are merged
    in one batch of arrays; all others go through the tokenizer itself.
    """
    tokenizer = Tokenizer.from_file(path)
    merges = MergeTable(path)
    split = regex.compile(PIECES).findall
    cache = _Cache()
    known = cache.__getitem__
    # Millions of small objects without cycles: looking for cycles takes a quarter of the time.
    gc.disable()

    def library(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(words: set[str]) -> None:
        parts: list[tuple[str, list[str]]] = []
        fresh: set[str] = set()
        for word in words:
            if "<|" in word or not (word.isascii() or max(word) <= "\xff"):
                cache[word] = library(word)
                continue
            low = word.lower()
            # Letters alone, or with one sign after them, need no pattern to be split.
            if low.isalpha():
                pieces = [low]
            elif low[-1] in PLAIN_SIGNS and low[:-1].isalpha():
                pieces = [low[:-1], low[-1]]
            else:
                pieces = split(low)
            parts.append((word, pieces))
            fresh.update([piece for piece in pieces if piece not in cache])
        todo = list(fresh)
        start = 0
        for some in in_batches([piece.encode() for piece in todo]):
            flat, counts = merges.merge(some)
            raw, ends = flat.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
            for piece, a, b in zip(todo[start : start + len(some)], [0, *ends], ends):
                cache[piece] = raw[a:b]
            start += len(some)
        for word, pieces in parts:
            if len(pieces) == 1:
                cache[word] = cache[pieces[0]]
            else:
                cache[word] = b"".join([cache[piece] for piece in pieces])

    def encode(texts: list[str]) -> list[bytes]:
        if len(cache) > cache_entries:
            cache.clear()
        whole = [None if _ODD_SPACE.search(text) else text.split() for text in texts]
        found = [list(map(known, words)) if words else [] for words in whole]
        if cache.missed:
            new, cache.missed = cache.missed, set()
            learn(new)
        return [
            library(text)
            if words is None
            else b"".join([cache[w] if ids is None else ids for w, ids in zip(words, ids_of)])
            for text, words, ids_of in zip(texts, whole, found)
        ]

    return encode


PIECE_SCHEMA = (
    "doc_id {kind}, piece int, start long, length long, ids_crc32 long, chunk int, nth long"
)


def cut_documents(
    df: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    texts_at_once: int = 256,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: its ids, then ``end_id``, cut at ``capacity``.

    A null text is empty and is one piece of one id. ``chunk`` and ``nth`` number the
    pieces of one length within a task. ``with_ids`` adds the ids themselves.
    """
    kind = df.schema[id_column].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def body():
        encode = id_encoder(vocabulary)
        chunk = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)

        def one(batch: pa.RecordBatch) -> list:
            rows, ids_out = [], []
            for first in range(0, batch.num_rows, texts_at_once):
                texts = batch.column(1).slice(first, texts_at_once).to_pylist()
                for i, raw in enumerate(encode(texts), first):
                    raw += end
                    for number, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at : at + 4 * capacity]
                        length = len(part) // 4
                        rows.append((i, number, at // 4, length, zlib.crc32(part), seen[length]))
                        seen[length] += 1
                        if with_ids:
                            ids_out.append(np.frombuffer(part, "<u4").astype(np.int32))
            table = np.array(rows, np.int64).reshape(-1, 6)
            columns = [
                batch.column(0).take(pa.array(table[:, 0])),
                pa.array(table[:, 1].astype(np.int32)),
                pa.array(table[:, 2]),
                pa.array(table[:, 3]),
                pa.array(table[:, 4]),
                pa.array(np.full(len(table), chunk, np.int32)),
                pa.array(table[:, 5]),
            ]
            if with_ids:
                columns.append(pa.array(ids_out, pa.list_(pa.int32())))
            return columns

        return one

    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    schema = PIECE_SCHEMA.format(kind=kind) + (", ids array<int>" if with_ids else "")
    return map_columns(rows, schema, body)


class Run(NamedTuple):
    """``repeat`` equal sequences, each of these lengths, in this order."""

    repeat: int
    lengths: tuple[int, ...]


def patterns_of(histogram: np.ndarray, partners: int = 24) -> list[tuple[int, ...]]:
    """Patterns of one to four lengths that leave at most one part in 256 unused.

    Partners of a length are taken at even steps of the histogram's mass, and the last
    of a pattern is the largest length there is that still fits.
    """
    capacity = len(histogram) - 1
    present = np.flatnonzero(histogram)
    if not len(present):
        return []
    mass = np.cumsum(histogram[present])
    picks = np.unique(np.searchsorted(mass, np.linspace(0, mass[-1], partners + 2)[1:-1]))
    steps = present[np.minimum(picks, len(present) - 1)].tolist()
    slack = max(1, capacity // 256)
    # The largest present length of at most each size.
    largest = np.zeros(capacity + 1, np.int64)
    largest[present] = present
    largest = np.maximum.accumulate(largest).tolist()
    found: set[tuple[int, ...]] = set()

    def close(lengths: tuple[int, ...]) -> None:
        room = capacity - sum(lengths)
        if room >= 0 and (last := largest[room]) and room - last <= slack:
            found.add(tuple(sorted((*lengths, last), reverse=True)))
        if 0 <= room <= slack and lengths:
            found.add(tuple(sorted(lengths, reverse=True)))

    for a in present.tolist():
        close((a,))
        for b in steps:
            close((a, b))
            for c in steps:
                if c <= b:
                    close((a, b, c))
    return sorted(found, reverse=True)


def fit_repeats(
    patterns: list[tuple[int, ...]], histogram: np.ndarray, rounds: int = 300
) -> np.ndarray:
    """Repeat counts x >= 0 that make the patterns' lengths fit the histogram best.

    Least squares by multiplicative updates, which keep every count non-negative.
    """
    sizes = np.array([len(p) for p in patterns])
    lengths = np.concatenate([np.array(p) for p in patterns])
    owner = np.repeat(np.arange(len(patterns)), sizes)
    # Rows are weighed so that rare lengths count as much as frequent ones.
    weight = 1 / np.maximum(histogram, 1).astype(float)
    wanted = np.bincount(owner, (weight * histogram)[lengths], len(patterns))
    uses = np.bincount(lengths, minlength=len(histogram))
    x = np.bincount(owner, (histogram / np.maximum(uses, 1))[lengths], len(patterns)) / sizes
    for _ in range(rounds):
        made = np.bincount(lengths, x[owner], len(histogram))
        x *= wanted / np.maximum(np.bincount(owner, (weight * made)[lengths], len(patterns)), 1e-12)
    return x


def best_fit_rest(left: np.ndarray) -> Iterator[Run]:
    """Pack what is left: the longest first, then always the longest that still fits."""
    capacity = len(left) - 1
    while True:
        present = np.flatnonzero(left)
        if not len(present):
            return
        room, lengths = capacity, []
        spare = left.copy()
        while room:
            fits = present[: np.searchsorted(present, room, "right")]
            fits = fits[spare[fits] > 0]
            if not len(fits):
                break
            length = int(fits[-1])
            many = min(int(spare[length]), room // length)
            # One at a time where a single one leaves room for a better fit.
            many = many if many * length == room else 1
            lengths += [length] * many
            spare[length] -= many
            room -= many * length
        used, each = np.unique(lengths, return_counts=True)
        repeat = int((left[used] // each).min())
        left[used] -= repeat * each
        yield Run(repeat, tuple(lengths))


def plan_packing(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that use every length exactly as often as it occurs."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] += count
    runs = []
    if left[capacity]:
        runs.append(Run(int(left[capacity]), (capacity,)))
        left[capacity] = 0
    patterns = patterns_of(left)
    if patterns:
        x = fit_repeats(patterns, left)
        # Those that fill best, and of those the most repeated, are rounded first.
        fill = np.array([sum(p) for p in patterns])
        for i in np.lexsort((-x, -fill)):
            each_length, each = np.unique(patterns[i], return_counts=True)
            repeat = min(int(x[i] + 0.5), int((left[each_length] // each).min()))
            if repeat > 0:
                left[each_length] -= repeat * each
                runs.append(Run(repeat, patterns[i]))
    runs.extend(best_fit_rest(left))
    return runs


def plan_rows(runs: list[Run]) -> np.ndarray:
    """Per run and length: length, first rank, first sequence, pieces each, first offset."""
    rows, ranks, sequence = [], {}, 0
    for repeat, lengths in runs:
        at = 0
        for length in dict.fromkeys(lengths):
            each = lengths.count(length)
            rank = ranks.get(length, 0)
            rows.append((length, rank, sequence, each, at))
            ranks[length] = rank + repeat * each
            at += each * length
        sequence += repeat
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


_RANK_BITS = 44


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (of ``cut_documents``, written once) with ``sequence_id`` and ``offset``.

    The driver gets a histogram of at most ``capacity`` lengths. Ranks within a length
    are counted per task and summed over tasks, so no length, however frequent, is
    ordered in one place.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_rows(plan_packing(histogram, capacity))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        "chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")
    )
    ranked = pieces.join(firsts, ["chunk", "length"]).withColumn("_rank", F.col("_before") + F.col("nth"))
    shared = spark.sparkContext.broadcast(plan)
    kept = [c for c in pieces.columns if c not in ("chunk", "nth")]
    rows = ranked.select(*kept, "_rank")
    length_at, rank_at = kept.index("length"), len(kept)

    def body():
        table = shared.value
        keys = table[:, 0] << _RANK_BITS | table[:, 1]

        def one(batch: pa.RecordBatch) -> list:
            length = batch.column(length_at).to_numpy().astype(np.int64)
            rank = batch.column(rank_at).to_numpy()
            row = table[np.searchsorted(keys, length << _RANK_BITS | rank, "right") - 1]
            past = rank - row[:, 1]
            return [
                *batch.columns[:rank_at],
                pa.array(row[:, 2] + past // row[:, 3]),
                pa.array(row[:, 4] + past % row[:, 3] * length),
            ]

        return one

    schema = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in kept)
    return map_columns(rows, f"{schema}, sequence_id long, offset long", body)


def pack_documents(
    df: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every piece of every document with its place: sequence and offset, without gaps.

    Null and empty texts are one piece of one id; repeated rows are packed each; an
    empty table gives no rows; other columns are ignored.
    """
    pieces = cut_documents(df, vocabulary, capacity, end_id, id_column, text_column)
    return pack(written(pieces, "pieces"), capacity)
