"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of arrays.

Distinct pre-tokens of a batch are held as one ragged array of symbols. In each
round every sequence finds its lowest-ranked adjacent pair and merges all its
occurrences at once; a sequence without a pair of the vocabulary is finished, and
its surviving symbols are its tokens.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import map_columns, text_or_empty

# Fixed value: how the vocabulary's own files split text before merging.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.int32(2**31 - 1)
CACHE_ENTRIES = 400_000
BATCH_SYMBOLS = 100_000  # arrays of this size stay in the processor's cache


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {byte: chr(byte) for byte in plain}
    rest = [byte for byte in range(256) if byte not in symbols]
    symbols.update({byte: chr(256 + i) for i, byte in enumerate(rest)})
    return [symbols[byte] for byte in range(256)]


class MergeTable:
    """Vocabulary and merge ranks of a tokenizer file, for whole arrays of symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int32)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        ids = np.array(
            [
                (vocab[a], vocab[b], vocab[a + b])
                for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
            ],
            np.int64,
        ).reshape(-1, 3)
        self._fill(ids[:, 0] << 32 | ids[:, 1], ids[:, 2])

    def _fill(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """An open-addressing table of pair -> (rank, merged id), at most an eighth full."""
        self.bits = max(10, int(len(keys)).bit_length() + 3)
        size = 1 << self.bits
        self.keys = np.full(size + 64, -1, np.int64)
        self.rank = np.full(size + 64, NONE, np.int32)
        self.merged = np.zeros(size + 64, np.int32)
        self.probes = 1
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist())):
            probes = 1
            while self.keys[slot] not in (-1, key):
                slot, probes = slot + 1, probes + 1
            if self.keys[slot] == -1:
                self.keys[slot], self.rank[slot], self.merged[slot] = key, rank, merged[rank]
            self.probes = max(self.probes, probes)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; a slot of rank NONE where there is no such merge."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slot(keys)
        open_ = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slots[open_] += 1
            found = self.keys[slots[open_]]
            open_ = open_[(found != keys[open_]) & (found != -1)]
        # What stopped at another pair's slot has no merge: send it to the empty end.
        slots[self.keys[slots] != keys] = len(self.keys) - 1
        return slots

    def merge(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of all ``words``, one after the other, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids = self.first[raw]
        ends = np.cumsum(sizes)[sizes > 0] - 1
        ids[ends] = self.last[raw[ends]]
        owner = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_place = [], []
        place = np.arange(len(ids))
        # Ranks of pairs are looked up once; after a merge only its neighbours' are renewed.
        slots = np.full(len(ids), len(self.keys) - 1, np.int64)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        slots[inner] = self._find(ids[inner], ids[inner + 1])
        while len(ids):
            rank = self.rank[slots]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(ids)])
            lowest = np.minimum.reduceat(rank, starts)
            open_ = lowest != NONE
            if not open_.all():
                live = np.repeat(open_, lengths)
                done_ids.append(ids[~live])
                done_place.append(place[~live])
                ids, owner, place, slots, rank = (x[live] for x in (ids, owner, place, slots, rank))
                lowest, lengths = lowest[open_], lengths[open_]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, lengths))
            # In a run of overlapping occurrences, as in "aaa", every other one counts.
            run = np.flatnonzero(np.r_[True, np.diff(hit) != 1])
            if len(run) != len(hit):
                index = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
                hit = hit[index % 2 == 0]
            ids[hit] = self.merged[slots[hit]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            moved = np.cumsum(keep) - 1
            at = moved[hit]
            ids, owner, place, slots = ids[keep], owner[keep], place[keep], slots[keep]
            touched = np.r_[at, at[at > 0] - 1]
            inside = touched + 1 < len(ids)
            inside[inside] = owner[touched[inside] + 1] == owner[touched[inside]]
            slots[touched[~inside]] = len(self.keys) - 1
            touched = touched[inside]
            slots[touched] = self._find(ids[touched], ids[touched + 1])
        if done_ids:
            ids, place = np.concatenate(done_ids), np.concatenate(done_place)
            order = np.argsort(place, kind="stable")
            ids, place = ids[order], place[order]
        else:
            place = np.zeros(0, np.int64)
        counts = np.bincount(np.repeat(np.arange(len(words)), sizes)[place], minlength=len(words))
        return ids, counts


def in_batches(words: Sequence[bytes], symbols: int = BATCH_SYMBOLS):
    """Slices of ``words`` of at most ``symbols`` bytes; a longer word is one by itself."""
    start = size = 0
    for i, word in enumerate(words):
        if size and size + len(word) > symbols:
            yield words[start:i]
            start, size = i, 0
        size += len(word)
    if start < len(words):
        yield words[start:]


def text_counter(path: str, cache_entries: int = CACHE_ENTRIES) -> Callable[[Sequence[str]], list[int]]:
    """A function from texts to token counts; special strings in a text are one token each."""
    merges = MergeTable(path)
    split = regex.compile(SPLIT_PATTERN).findall
    specials = [s for s in merges.special if s]
    special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True))))
    cache: dict[str, int] = {}

    def count(texts: Sequence[str]) -> list[int]:
        extra = [0] * len(texts)
        pieces: list[list[str]] = []
        for i, text in enumerate(texts):
            if specials and special.search(text):
                parts = special.split(text)
                extra[i] = len(parts) - 1
                pieces.append([word for part in parts for word in split(part)])
            else:
                pieces.append(split(text))
        if len(cache) > cache_entries:
            cache.clear()
        new = {word for words in pieces for word in words if word not in cache}
        fresh = list(new)
        start = 0
        for some in in_batches([word.encode("utf-8", "surrogatepass") for word in fresh]):
            _, counts = merges.merge(some)
            cache.update(zip(fresh[start : start + len(some)], counts.tolist()))
            start += len(some)
        known = cache.__getitem__
        return [e + sum(map(known, words)) for e, words in zip(extra, pieces)]

    return count


def count_tokens(
    df: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 512,
    texts_at_once: int = 256,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row's whole text.

    ``vocabulary`` is a byte-level BPE file that every worker can read. A null text
    counts as empty: no bytes, no tokens. A null id stays null, repeated rows are
    counted each, an empty table gives no rows, and other columns are ignored. Work
    is row by row: no shuffle, and no more than ``texts_at_once`` texts are split at
    a time, so a worker holds a few long texts and a cache of bounded size.
    """

    def body():
        count = text_counter(vocabulary)

        def one(batch: pa.RecordBatch) -> list:
            texts, totals = batch.column(1), []
            for start in range(0, batch.num_rows, texts_at_once):
                totals += count(texts.slice(start, texts_at_once).to_pylist())
            tokens = np.array(totals, np.int64)
            return [batch.column(0), batch.column(2), pa.array(tokens), pa.array(tokens > limit)]

        return one

    rows = df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_or_empty(text_column).alias("text"),
        F.octet_length(text_or_empty(text_column)).cast("long").alias("n_bytes"),
    )
    return map_columns(rows, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", body)
