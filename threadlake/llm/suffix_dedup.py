"""Removal of passages that an earlier document holds, by suffix arrays of content buckets.

A match of ``length`` bytes is a window. The smallest hash of a window's k-grams (its anchor)
depends on nothing but the window, so equal windows of any two documents have the same
anchor, and windows side by side mostly share one. That decides where windows meet:

1. Documents are dealt to blocks of bounded size, staged in buckets by block and read in
   place from then on.
2. Each block sends its distinct anchors to buckets by anchor and gets back, as bits, which
   of them more than one document holds. All other windows are unique and go no further.
3. Runs of windows with such an anchor are pieces. A block sends each distinct piece once,
   with the smallest document that holds it. A bucket sorts the suffixes of its pieces by
   deep-shallow sorting; windows that are equal lie side by side then. The answer is a bit
   for each window, in the order in which the block sent its pieces: whether a document
   smaller than the one sent holds it.
4. Each block removes what its documents hold from smaller ones.

However often a document, passage or line repeats, a block sends it once. An anchor of more
than ``HOT_PIECES`` pieces, which would make its bucket a large one, is spread over all
buckets by the content of its windows. That sends each window's text by itself, many times
the bytes of a piece, so an anchor of many blocks that send a piece or two is not spread.

What blocks send is compressed, and the shuffle files of a step go before the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import kept, shuffles_dropped, text_or_empty
from threadlake.llm.deep_shallow import WORD, padded, sort_suffixes, words
from threadlake.session import stage, stage_bucketed

BLOCK_BYTES = 8_000_000
MOST_BUCKETS = 100_000
# About the pieces that a bucket gets anyway, some 6 MB.
HOT_PIECES = 1 << 16
CHUNK = 1 << 20
ANCHOR_BYTES = 16
# Rows without an id come after all others: they take nothing away from anybody.
NO_ID = np.iinfo(np.int64).max

FACTOR = 0x100000001B3
MIXER = np.uint64(0x9E3779B97F4A7C15)
ANSWERS = "block long, bucket long, kind int, payload binary"
SENT = "block long, bucket long, keys binary, owners binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


@dataclass(frozen=True)
class Plan:
    """Window length, number of content buckets and what counts as a hot anchor."""

    length: int
    buckets: int
    hot_pieces: int = HOT_PIECES
    k: int = field(init=False)
    most: int = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "k", min(ANCHOR_BYTES, (self.length + 1) // 2))
        # A piece holds at most as many windows as one k-gram is part of.
        object.__setattr__(self, "most", self.length - self.k + 1)

    @property
    def width(self) -> int:
        """Bytes of a piece's record: its text, filled up, and its number of windows."""
        return self.length + self.most


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` bytes at each place, by doubling."""
    count = len(data) - k + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    part, size, at = data.astype(np.uint64) + np.uint64(1), 1, 0
    while True:
        factor = np.uint64(pow(FACTOR, size, 1 << 64))
        if k & size:
            total *= factor
            total += part[at : at + count]
            at += size
        if 2 * size > k:
            break
        part = part[:-size] * factor + part[size:]
        size *= 2
    total ^= total >> np.uint64(31)
    total *= MIXER
    total ^= total >> np.uint64(29)
    return total


def window_anchors(data: np.ndarray, plan: Plan) -> np.ndarray:
    """The smallest hash of the k-grams of each window, whose lowest bit is left for a flag."""
    least, size = gram_hashes(data, plan.k), 1
    while 2 * size <= plan.most:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < plan.most:
        rest = plan.most - size
        least = np.minimum(least[:-rest], least[rest:])
    return least & ~np.uint64(1)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places ``start .. start + size - 1``, one after another."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])


class Block:
    """The documents of one block in a fixed order, and the runs of windows in them."""

    def __init__(self, rows: pa.Table, plan: Plan):
        rows = rows.sort_by("rid").combine_chunks()
        self.plan = plan
        self.ids = rows.column("doc_id")
        texts = rows.column("text").combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.binary())
        wide = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        whole = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.owners = np.array(self.ids.fill_null(NO_ID))
        self._find_runs()

    def _find_runs(self) -> None:
        """Runs of at most ``most`` windows with one anchor: start, size and anchor of each."""
        length, most = self.plan.length, self.plan.most
        starts, sizes, anchors = [], [], []
        total = max(0, len(self.data) - length + 1)
        inside = np.ones(total, bool)
        for end in self.offsets[1:]:
            inside[max(0, end - length + 1) : end] = False
        for begin in range(0, total, CHUNK):
            least = window_anchors(self.data[begin : begin + CHUNK + length - 1], self.plan)
            good = inside[begin : begin + CHUNK]
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (good[1:] != good[:-1])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(least)))
            keep = good[first]
            first, size = first[keep], size[keep]
            parts = -(-size // most)
            at = ragged(np.zeros(len(parts), np.int64), parts)
            starts.append(np.repeat(first, parts) + at * most + begin)
            sizes.append(np.minimum(np.repeat(size, parts) - at * most, most))
            anchors.append(np.repeat(least[first], parts))
        self.starts = np.concatenate([np.zeros(0, np.int64), *starts])
        self.sizes = np.concatenate([np.zeros(0, np.int64), *sizes])
        self.anchors = np.concatenate([np.zeros(0, np.uint64), *anchors])
        self.documents = np.searchsorted(self.offsets, self.starts, side="right") - 1

    def keys(self) -> Dealt:
        """Distinct anchors, and how many pieces of each the block would send.

        The lowest bit of those that several documents hold is set.
        """
        by = np.argsort(self.anchors, kind="stable")
        anchors, documents = self.anchors[by], self.documents[by]
        new = np.ones(len(by), bool)
        new[1:] = anchors[1:] != anchors[:-1]
        several = np.zeros(len(by), bool)
        several[1:] = ~new[1:] & (documents[1:] != documents[:-1])
        first = np.flatnonzero(new)
        flags = np.logical_or.reduceat(several, first) if len(first) else np.zeros(0, bool)
        self.key_of_run = np.empty(len(by), np.int64)
        self.key_of_run[by] = np.cumsum(new) - 1
        keys = anchors[first]
        return Dealt(keys | flags, (keys >> np.uint64(1)) % np.uint64(self.plan.buckets), self._piece_counts(by, first))

    def _piece_counts(self, by: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each anchor its pieces that differ, told apart by size, beginning and end."""
        runs = np.diff(np.append(first, len(by)))
        counts = np.ones(len(first), np.uint32)
        several = np.flatnonzero(runs > 1)
        if not len(several):
            return counts
        key = np.repeat(several, runs[several])
        run = by[ragged(first[several], runs[several])]
        data = padded(self.data)
        ends = self.starts[run] + self.sizes[run] + (self.plan.length - 1)
        marks = self.sizes[run].astype(np.uint64)
        for at in (self.starts[run], self.starts[run] + WORD, np.maximum(ends - WORD, 0), np.maximum(ends - 2 * WORD, 0)):
            marks = (marks ^ words(data, np.minimum(at, len(self.data)), WORD)) * MIXER
            marks ^= marks >> np.uint64(29)
        order = np.lexsort((marks, key))
        key, marks = key[order], marks[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (marks[1:] != marks[:-1])
        counts[several] = np.add.reduceat(new, np.flatnonzero(np.append(True, key[1:] != key[:-1])), dtype=np.uint32)
        return counts

    def pieces(self, bits: dict[int, bytes]) -> Dealt:
        """Distinct pieces whose anchors are shared, given the answers to ``keys``.

        Leaves ``piece_starts``, ``piece_sizes`` and ``piece_of``, the place of each in the
        distinct ones, for ``result``.
        """
        plan, keys = self.plan, self.keys()
        shared, hot = np.zeros(len(keys.values), bool), np.zeros(len(keys.values), bool)
        for bucket, places in keys.parts():
            both = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=2 * len(places)).astype(bool)
            shared[places], hot[places] = both[: len(places)], both[len(places) :]
        runs = np.flatnonzero(shared[self.key_of_run])
        # Windows of a hot anchor are pieces by themselves.
        single = hot[self.key_of_run[runs]]
        times = np.where(single, self.sizes[runs], 1)
        run = np.repeat(runs, times)
        within = ragged(np.zeros(len(times), np.int64), times)
        self.piece_starts = self.starts[run] + within
        self.piece_sizes = np.where(np.repeat(single, times), 1, self.sizes[run])
        self.piece_documents = self.documents[run]
        records = self._records()
        owners = self.owners[self.piece_documents]
        distinct, self.piece_of = np.unique(records, return_inverse=True)
        least = np.full(len(distinct), NO_ID)
        np.minimum.at(least, self.piece_of, owners)
        anchors = np.zeros(len(distinct), np.uint64)
        anchors[self.piece_of] = self.anchors[run]
        spread = np.zeros(len(distinct), bool)
        spread[self.piece_of] = np.repeat(single, times)
        target = anchors >> np.uint64(1)
        if spread.any():
            texts = np.frombuffer(distinct[spread].tobytes(), np.uint8).reshape(-1, plan.width)
            target[spread] += _content_hash(texts[:, : plan.length])
        return Dealt(distinct, target % np.uint64(plan.buckets), least)

    def _records(self) -> np.ndarray:
        plan = self.plan
        data = np.concatenate([self.data, np.zeros(plan.width, np.uint8)])
        records = np.empty((len(self.piece_starts), plan.width), np.uint8)
        text = np.arange(plan.width - 1)
        for begin in range(0, len(records), 1 << 16):
            part = slice(begin, begin + (1 << 16))
            records[part, :-1] = data[self.piece_starts[part, None] + text]
            records[part, :-1] *= text < (self.piece_sizes[part, None] + plan.length - 1)
        records[:, -1] = self.piece_sizes
        return records.reshape(-1).view(f"S{plan.width}")

    def result(self, bits: dict[int, bytes], answers: dict[int, bytes]) -> pa.RecordBatch:
        """Rows of ``RESULT``, given the answers to ``pieces``."""
        pieces = self.pieces(bits)
        sizes = pieces.values.view(np.uint8).reshape(-1, self.plan.width)[:, -1].astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        lower = np.zeros(int(sizes.sum()), bool)
        for bucket, places in pieces.parts():
            at = ragged(begins[places], sizes[places])
            lower[at] = np.unpackbits(np.frombuffer(answers[bucket], np.uint8), count=len(at))
        # Where removed windows start; a byte goes if the last start before it is near enough.
        last = np.full(len(self.data), -self.plan.length, np.int32)
        step = 1 << 17
        for begin in range(0, len(self.piece_starts), step):
            part = slice(begin, begin + step)
            size = self.piece_sizes[part]
            at = ragged(self.piece_starts[part], size)
            # A smaller document holds the window elsewhere, or the piece in this block.
            here = pieces.owners[self.piece_of[part]] < self.owners[self.piece_documents[part]]
            smaller = lower[ragged(begins[self.piece_of[part]], size)] | np.repeat(here, size)
            last[at[smaller]] = at[smaller]
        np.maximum.accumulate(last, out=last)
        gone = np.arange(len(last), dtype=np.int32) - last < self.plan.length
        del last, lower
        begins_here = gone.copy()
        begins_here[1:] &= ~gone[:-1]
        # Spans do not cross from one document into the next.
        heads = self.offsets[:-1][np.diff(self.offsets) > 0]
        begins_here[heads] = gone[heads]
        removed, spans = (np.diff(np.append(np.int32(0), np.cumsum(flags, dtype=np.int32))[self.offsets]).astype(np.int64) for flags in (gone, begins_here))
        size = np.diff(self.offsets)
        kept_offsets = np.append(0, np.cumsum(size - removed))
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(size), [None, pa.py_buffer(kept_offsets.astype(np.int64)), pa.py_buffer(self.data[~gone])]
        ).cast(pa.binary())
        ids = self.ids.combine_chunks() if isinstance(self.ids, pa.ChunkedArray) else self.ids
        ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
        return pa.table(
            [ids, pa.array(size), pa.array(removed), pa.array(spans), kept],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _content_hash(texts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(texts), np.uint64)
    for column in range(texts.shape[1]):
        total = total * np.uint64(FACTOR) + texts[:, column]
    return (total ^ (total >> np.uint64(32))) * MIXER >> np.uint64(3)


@dataclass
class Dealt:
    """Values, the bucket of each and its owner or count; a bucket's part is in the order of the values."""

    values: np.ndarray
    buckets: np.ndarray
    owners: np.ndarray

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        by = np.argsort(self.buckets, kind="stable")
        dealt = self.buckets[by]
        begins = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1])) if len(by) else []
        for begin, end in zip(begins, [*begins[1:], len(by)]):
            yield int(dealt[begin]), by[begin:end]

    def sent(self, block: int) -> pa.Table:
        rows = [
            (block, bucket, squeezed(self.values[places]), squeezed(self.owners[places]))
            for bucket, places in self.parts()
        ]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "bucket", "keys", "owners"])


def squeezed(values: np.ndarray) -> bytes:
    """Compressed values; numbers by their first bytes, second bytes and so on."""
    raw = values.view(np.uint8).reshape(-1, values.itemsize)
    plain = (raw if values.dtype.kind == "S" else raw.T).tobytes()
    return len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def opened(payload: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(payload[:8], "little")
    plain = np.frombuffer(pa.decompress(payload[8:], size, "zstd", asbytes=True), np.uint8)
    if kind[0] == "S":
        return plain.view(kind)
    return np.ascontiguousarray(plain.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _answer_keys(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    """Which anchors of a bucket more than one document holds, and which are hot."""

    def answer(rows: pa.Table) -> pa.Table:
        sent = [opened(row.as_py(), "<u8") for row in rows.column("keys")]
        keys = np.concatenate(sent)
        counts = np.concatenate([opened(row.as_py(), "<u4") for row in rows.column("owners")])
        distinct, place, times = np.unique(keys >> np.uint64(1), return_inverse=True, return_counts=True)
        several = times > 1
        several[place[(keys & np.uint64(1)) > 0]] = True
        shared, hot = several[place], (np.bincount(place, counts) > plan.hot_pieces)[place]
        ends = np.cumsum([len(part) for part in sent])
        answers = [
            np.packbits(np.concatenate([shared[end - len(part) : end], hot[end - len(part) : end]])).tobytes()
            for part, end in zip(sent, ends)
        ]
        return _answers(rows, 0, answers)

    return answer


def _answer_pieces(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    """Which windows of a bucket's pieces a smaller document holds than the one sent."""

    def answer(rows: pa.Table) -> pa.Table:
        sent = [opened(row.as_py(), f"S{plan.width}") for row in rows.column("keys")]
        owners = np.concatenate([opened(row.as_py(), "<i8") for row in rows.column("owners")])
        distinct, place = np.unique(np.concatenate(sent), return_inverse=True)
        own = np.full(len(distinct), NO_ID)
        np.minimum.at(own, place, owners)
        data = np.frombuffer(distinct.tobytes(), np.uint8)
        sizes = data[plan.width - 1 :: plan.width].astype(np.int64)
        windows = ragged(np.arange(len(distinct)) * plan.width, sizes)
        piece = np.repeat(np.arange(len(distinct)), sizes)
        order, fresh = sort_suffixes(padded(data), windows, plan.length)
        least = np.empty(len(windows), np.int64)
        begins = np.flatnonzero(fresh)
        least[order] = np.repeat(
            np.minimum.reduceat(own[piece[order]], begins), np.diff(np.append(begins, len(order)))
        )
        begins = np.cumsum(sizes) - sizes
        answers, end = [], 0
        for part in sent:
            mine, sender = place[end : end + len(part)], owners[end : end + len(part)]
            end += len(part)
            at = ragged(begins[mine], sizes[mine])
            answers.append(np.packbits(least[at] < np.repeat(sender, sizes[mine])).tobytes())
        return _answers(rows, 1, answers)

    return answer


def _answers(rows: pa.Table, kind: int, payloads: list[bytes]) -> pa.Table:
    return pa.table(
        [
            rows.column("block"), rows.column("bucket"),
            pa.array(np.full(len(payloads), kind, np.int32)), pa.array(payloads, pa.binary()),
        ],
        names=["block", "bucket", "kind", "payload"],
    )


def _of_kind(answers: pa.Table, kind: int) -> dict[int, bytes]:
    return {
        row["bucket"]: row["payload"]
        for row in answers.select(["bucket", "kind", "payload"]).to_pylist()
        if row["kind"] == kind
    }


def _key_sender(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    def send(rows: pa.Table) -> pa.Table:
        return Block(rows, plan).keys().sent(rows.column("block")[0].as_py())

    return send


def _piece_sender(plan: Plan) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def send(rows: pa.Table, answers: pa.Table) -> pa.Table:
        return Block(rows, plan).pieces(_of_kind(answers, 0)).sent(rows.column("block")[0].as_py())

    return send


def _remover(plan: Plan) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def remove(rows: pa.Table, answers: pa.Table) -> pa.Table:
        return Block(rows, plan).result(_of_kind(answers, 0), _of_kind(answers, 1))

    return remove


def remove_repeats(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 50,
    finish: Callable[[DataFrame], DataFrame] = lambda out: out,
    block_bytes: int = BLOCK_BYTES,
    hot_blocks: int = HOT_PIECES,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: a row for every row.

    Every byte goes that is covered by a string of ``length`` bytes (at most 128) which also
    starts in a document with a smaller id; ``kept`` are the bytes that stay and ``n_spans``
    the maximal removed runs. Strings are judged on the input, never across documents.
    ``finish`` maps the result to what of it is stored in the shared folder. Anchors of which
    blocks send more than ``hot_blocks`` pieces are spread.

    A null text is empty; a document shorter than ``length`` loses nothing. Rows with equal
    ids take nothing from each other, so repeated rows stay. A row without an id comes after
    all others. Other columns play no part, and an empty table gives no rows.
    """
    if not 1 <= length <= 128:
        raise ValueError("a string has 1 to 128 bytes")
    spark = df.sparkSession
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    plan = Plan(length, min(2 * blocks, MOST_BUCKETS), hot_blocks)
    numbered = rows.select("doc_id", "text", F.monotonically_increasing_id().alias("rid"))
    dealt = numbered.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)))
    name = ""

    def found() -> DataFrame:
        nonlocal name
        texts, name = stage_bucketed(dealt, "block", "suffix_blocks", min(blocks, MOST_BUCKETS))
        own = texts.groupBy("block")
        keys = own.applyInArrow(_key_sender(plan), SENT)
        bits, _ = stage(keys.groupBy("bucket").applyInArrow(_answer_keys(plan), ANSWERS), "suffix_bits")
        pieces = own.cogroup(bits.groupBy("block")).applyInArrow(_piece_sender(plan), SENT)
        owners, _ = stage(pieces.groupBy("bucket").applyInArrow(_answer_pieces(plan), ANSWERS), "suffix_owners")
        answers = bits.unionByName(owners).groupBy("block")
        return finish(own.cogroup(answers).applyInArrow(_remover(plan), RESULT))

    try:
        with shuffles_dropped(spark):
            return kept(spark, "suffix-dedup", found)
    finally:
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def digests(result: DataFrame) -> DataFrame:
    """``remove_repeats`` with a digest in place of the bytes that stay."""
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
