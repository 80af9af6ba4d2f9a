"""Exact Jaccard self-join on word n-grams, down to the classes of linked documents.

Documents with equal sets are one node. Each node's shingles have one order that all nodes
share: by hash, but shingles that stand in more than ``common`` prefixes come last, the
rarer of them first. Two sets that are similar enough share a shingle of their prefixes in
that order, so nodes are joined on prefix shingles only; pairs pass a length, a positional and
a suffix filter and are verified once. Not all pairs of a list are made: its nodes meet a
few pivots first, which then leave the list, and at last only nodes that are not linked yet meet.
What a step stages is deleted when its result is written.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlake.llm.common import arrow_rows, kept, map_columns, text_or_empty, written
from threadlake.llm.components import components

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
CACHE_ENTRIES = 300_000
SHORT = 64  # sets up to this size are kept whole, not only their prefix
BINS = 128  # parts of the hash range that the suffix filter counts
BROADCAST_ROWS = 1_000_000
BATCH = 1024  # rows of an Arrow batch: each may hold two whole sets
PIVOTS = 8  # of a long list; a list has no more than one for as many nodes
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class Similarity(NamedTuple):
    """``percent`` of the union must be common; ``words`` in a shingle."""

    words: int = 4
    percent: int = 85

    def prefix(self, n: int) -> int:
        """How many of ``n`` shingles the prefix needs."""
        return n - -(-self.percent * n // 100) + 1

    def head(self, n: int) -> int:
        """How many are kept in hash order, so that some may prove common."""
        return n if n <= SHORT else min(n, self.prefix(n) * 5 // 4)


def hasher(cache_entries: int = CACHE_ENTRIES):
    """A function from words to 64-bit hashes, with a cache of bounded size."""

    class Known(dict):
        def __missing__(self, word: bytes) -> int:
            value = self[word] = xxhash.xxh3_64_intdigest(word)
            return value

    cache = Known()

    def hashes(words: list[bytes]) -> np.ndarray:
        if len(cache) > cache_entries:
            cache.clear()
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))

    return hashes


def words_of(text: str) -> list[bytes]:
    """Words of the lower-cased text (A-Z only), split at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingles_of(words: list[bytes], size: int, hashes) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes; fewer words than ``size`` are one."""
    if not words:
        return np.zeros(0, np.uint64)
    of_words = hashes(words)
    width = min(size, len(of_words))
    total = np.zeros(len(of_words) - width + 1, np.uint64)
    for i in range(width):
        total = (total ^ of_words[i : i + len(total)]) * _ODD
        total ^= total >> np.uint64(29)
    # A short sequence is no shingle of ``size`` words, even if it reads the same.
    total = (total ^ np.uint64(width)) * _MIX
    total ^= total >> np.uint64(32)
    # 63 bits, so that signed numbers keep their order.
    return np.unique(total >> np.uint64(1))


def _set_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _bins(shingles: np.ndarray) -> bytes:
    """Counts of the set in equal parts of the hash range, each up to 255."""
    counts = np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=BINS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


SET_SCHEMA = "doc_id {kind}, sid binary, n int, head array<long>, bins binary"


def document_sets(df: DataFrame, rule: Similarity, id_column: str, text_column: str) -> DataFrame:
    """Per row: id and size of its shingle set, its first shingles and its bins."""
    kind = df.schema[id_column].dataType.simpleString()

    def body():
        hashes = hasher()

        def one(batch: pa.RecordBatch) -> list:
            sids, sizes, heads, bins = [], [], [], []
            for text in batch.column(1):
                found = shingles_of(words_of(text.as_py()), rule.words, hashes)
                n = len(found)
                sizes.append(n)
                sids.append(_set_id(found) if n else None)
                heads.append(found[: rule.head(n)].view(np.int64) if n else None)
                bins.append(_bins(found) if n else None)
            return [
                batch.column(0), pa.array(sids, pa.binary()), pa.array(sizes, pa.int32()),
                pa.array(heads, pa.list_(pa.int64())), pa.array(bins, pa.binary()),
            ]

        return one

    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    return map_columns(rows, SET_SCHEMA.format(kind=kind), body)


class Join:
    """The join of one table; each step is a method, tables between them are written."""

    def __init__(self, df: DataFrame, rule: Similarity, id_column: str, text_column: str, common: int = 32):
        self.df, self.rule, self.common = df, rule, common
        self.id_column, self.text_column = id_column, text_column
        sets = document_sets(df, rule, id_column, text_column)
        self.docs = written(sets.withColumn("rid", F.monotonically_increasing_id()), "sets")
        # One row of each set is its node. The others are few or many; where their counted
        # number is small, the sets need no shuffle to be freed of them.
        own = self.docs.where("n > 0").select("sid", "rid")
        first = own.groupBy("sid").agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("m"))
        self.firsts = written(first, "firsts")
        again = own.join(self.firsts.where("m > 1").select("sid", "first"), "sid").where("rid <> first").select("rid")
        self.nodes = self.docs.where("n > 0").join(_sized(written(again, "copies")), "rid", "left_anti")
        ids = self.docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m"))
        self.repeated_ids = not ids.where("m > 1").isEmpty()

    def counted(self) -> DataFrame:
        """``h, c``: shingles in the heads of two nodes or more, and of how many."""
        heads = self.nodes.select(F.explode("head").alias("h"))
        counts = heads.groupBy("h").agg(F.count(F.lit(1)).alias("c"))
        return written(counts.where("c > 1"), "counts")

    def sets_of(self, rids: DataFrame) -> DataFrame:
        """``rid, n, shingles`` (bytes) of some nodes, from their texts."""
        wanted = written(
            rids.select("rid").distinct().join(self.nodes.select("rid", "sid", "doc_id"), "rid"), "wanted"
        )
        texts = self.df.select(
            F.col(self.id_column).alias("_doc"), text_or_empty(self.text_column).alias("text")
        )
        rows = texts.join(_sized(wanted), F.col("_doc").eqNullSafe(F.col("doc_id"))).select("rid", "sid", "text")
        rule = self.rule

        def body():
            hashes = hasher()

            def one(batch: pa.RecordBatch) -> list:
                rid, sizes, sets = [], [], []
                for i in range(batch.num_rows):
                    found = shingles_of(words_of(batch.column(2)[i].as_py()), rule.words, hashes)
                    # A repeated id may belong to another text.
                    if len(found) and _set_id(found) == batch.column(1)[i].as_py():
                        rid.append(batch.column(0)[i].as_py())
                        sizes.append(len(found))
                        sets.append(found.tobytes())
                return [pa.array(rid, pa.int64()), pa.array(sizes, pa.int32()), pa.array(sets, pa.binary())]

            return one

        found = map_columns(rows, "rid long, n int, shingles binary", body)
        return written(found.dropDuplicates(["rid"]) if self.repeated_ids else found, "shingles")

    def postings(self) -> DataFrame:
        """``h, rid, n, place``: prefix shingles that another node may share."""
        return self._kept("postings", self._postings)

    def _kept(self, label: str, body) -> DataFrame:
        return kept(self.df.sparkSession, label, body)

    def _postings(self) -> DataFrame:
        rule, common = self.rule, self.common
        counts = self.counted()
        sizes = self.nodes.select("rid", "n")
        heads = self.nodes.select("rid", F.posexplode("head").alias("pos", "h"))
        shared = heads.join(counts, "h").groupBy("rid").agg(F.collect_list(F.struct("pos", "h", "c")).alias("e"))
        shared = shared.join(sizes, "rid")

        def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Places in the common order; -1 in ``place`` marks a node whose head is too short."""
            for batch in batches:
                rid, n = (batch.column(i).to_numpy() for i in (0, 1))
                n = n.astype(np.int64)
                owner, pos, h, c = _entries(batch.column(2), "pos", "h", "c")
                prefix, hot = rule.prefix(n), c > common
                cold = np.where(n <= SHORT, n, np.minimum(n, prefix * 5 // 4))
                short = np.bincount(owner[hot], minlength=len(n))
                cold = cold - short
                short = (cold < prefix) & (cold + short < n)
                # What is not common moves forward by the common ones before it, which come last.
                order = np.lexsort((pos, owner))
                earlier = np.cumsum(hot[order]) - hot[order]
                starts = _starts(owner[order])
                place = np.empty(len(h), np.int64)
                place[order] = pos[order] - (earlier - earlier[starts])
                late = np.flatnonzero(hot)
                late = late[np.lexsort((h[late], c[late], owner[late]))]
                place[late] = cold[owner[late]] + np.arange(len(late)) - _starts(owner[late])
                keep = (place < prefix[owner]) & ~short[owner]
                yield _postings_batch(
                    np.r_[h[keep], np.zeros(short.sum(), np.int64)], np.r_[rid[owner[keep]], rid[short]],
                    np.r_[n[owner[keep]], n[short]], np.r_[place[keep], np.full(short.sum(), -1)],
                )

        first = written(shared.select("rid", "n", "e").mapInArrow(ordered, POSTING), "postings")
        short = first.where("place < 0").select("rid")
        if short.isEmpty():
            return first
        more = self._whole_order(short, counts)
        # A shingle of these may stand alone in another node's prefix: fetch that one too.
        lone = written(more.select("h").distinct().join(counts.select("h"), "h", "left_anti"), "lone")
        least = lone.agg(F.min("h")).first()[0]
        if least is None:
            return first.where("place >= 0").unionByName(more)
        hot = counts.where(F.col("c") > common).select("h", F.lit(True).alias("hot"))
        candidates = self.nodes.select("rid", "n", F.posexplode("head").alias("pos", "h")).where(F.col("h") >= least)
        met = written(candidates.join(_sized(lone), "h").join(short, "rid", "left_anti"), "met")
        # Hot shingles before it move it forward.
        own = self.nodes.join(met.select("rid").distinct(), "rid").select("rid", F.posexplode("head").alias("p", "h"))
        before = written(own.join(hot, "h").groupBy("rid").agg(F.collect_list("p").alias("hot_at")), "before")
        placed = met.join(before, "rid", "left").select(
            "h", "rid", "n",
            (F.col("pos") - F.coalesce(F.size(F.filter("hot_at", lambda x: x < F.col("pos"))), F.lit(0)))
            .cast("int").alias("place"),
        ) if not before.isEmpty() else met.select("h", "rid", "n", F.col("pos").alias("place"))
        need = F.col("n") - F.ceil(F.col("n") * rule.percent / 100) + 1
        extra = placed.where(F.col("place") < need)
        return written(
            first.where("place >= 0").unionByName(more).unionByName(extra).dropDuplicates(["h", "rid"]), "postings"
        )

    def _whole_order(self, short: DataFrame, counts: DataFrame) -> DataFrame:
        """Prefix places of nodes whose head holds too many common shingles: from whole sets."""
        rule, common = self.rule, self.common
        sets = self.sets_of(short)

        rows = sets.select("rid", "shingles").mapInArrow(_opened, "rid long, h long")
        hot = counts.where(F.col("c") > common)
        late = rows.join(hot, "h").groupBy("rid").agg(F.collect_list(F.struct("h", "c")).alias("e"))

        def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = batch.column(1).to_numpy()
                owner, h, c = _entries(batch.column(3), "h", "c")
                bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
                best = []
                for n, blob, a, b in zip(sizes.tolist(), batch.column(2), bounds[:-1], bounds[1:]):
                    shingles = np.frombuffer(blob.as_buffer(), np.int64)
                    weight = np.zeros(n, np.int64)
                    weight[np.searchsorted(shingles, h[a:b])] = c[a:b]
                    best.append(shingles[np.argsort(weight, kind="stable")[: rule.prefix(n)]])
                if best:
                    lengths = [len(x) for x in best]
                    yield _postings_batch(
                        np.concatenate(best), np.repeat(batch.column(0).to_numpy(), lengths),
                        np.repeat(sizes, lengths), np.concatenate([np.arange(x) for x in lengths]),
                    )

        return written(
            sets.join(late, "rid", "left").select("rid", "n", "shingles", "e").mapInArrow(ordered, POSTING), "postings"
        )

    def _rarest_first(self, rids: DataFrame) -> DataFrame:
        """``h, rid, n, place``: prefixes in the order of exact counts among these nodes only.

        Shingles that no other of the nodes has come first. Only those that are shared are
        returned, with their places after them.
        """
        rule = self.rule
        sets = self.sets_of(rids)
        rows = sets.select("rid", "shingles").mapInArrow(_opened, "rid long, h long")
        shared = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        entries = rows.join(shared, "h").groupBy("rid").agg(F.collect_list(F.struct("c", "h")).alias("e"))

        def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rid, n = (batch.column(i).to_numpy() for i in (0, 1))
                n = n.astype(np.int64)
                owner, c, h = _entries(batch.column(2), "c", "h")
                order = np.lexsort((h, c, owner))
                owner, h = owner[order], h[order]
                alone = n - np.bincount(owner, minlength=len(n))
                place = alone[owner] + np.arange(len(h)) - _starts(owner)
                keep = place < rule.prefix(n)[owner]
                owner = owner[keep]
                yield _postings_batch(h[keep], rid[owner], n[owner], place[keep])

        ordered_rows = entries.join(sets.select("rid", "n"), "rid").select("rid", "n", "e")
        return written(ordered_rows.mapInArrow(ordered, POSTING), "postings")

    def _possible(self, pairs: DataFrame) -> DataFrame:
        """Length and positional filter.

        From its first common shingle on, at ``place``, a node can share no more than what is
        left of its set. The first common shingle of a pair passes if the pair is similar enough,
        so a pair that fails in one list still stands in that one.
        """
        small, large = F.least("n", "n2"), F.greatest("n", "n2")
        # Common shingles that a pair needs: percent / (100 + percent) of both sizes.
        need = self.rule.percent * (F.col("n") + F.col("n2"))
        most = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
        return pairs.where(
            (small * 100 >= large * self.rule.percent) & (most * (100 + self.rule.percent) >= need)
        )

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar enough, after the suffix filter."""
        return self._kept("links", lambda: self._verified(pairs))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        percent = self.rule.percent
        bins = self.nodes.select("rid", "n", "bins")

        def suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x, y = (
                        np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int64)
                        for i in (2, 3)
                    )
                    both = np.minimum(x, y).sum(axis=1)
                    sizes = batch.column(4).to_numpy().astype(np.int64) + batch.column(5).to_numpy()
                    # Bins stop counting at 255, where the filter no longer binds.
                    full = (x.max(axis=1) == 255) | (y.max(axis=1) == 255)
                    keep = full | (both * (100 + percent) >= percent * sizes)
                    yield pa.RecordBatch.from_arrays(
                        [c.filter(pa.array(keep)) for c in batch.columns[:2]], names=["a", "b"]
                    )

        left = bins.select(F.col("rid").alias("a"), F.col("bins").alias("x"), F.col("n").alias("nx"))
        right = bins.select(F.col("rid").alias("b"), F.col("bins").alias("y"), F.col("n").alias("ny"))
        sized = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "nx", "ny")
        likely = written(sized.mapInArrow(suffix, "a long, b long"), "likely")
        sets = self.sets_of(likely.select(F.explode(F.array("a", "b")).alias("rid")))

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                if keep:
                    yield pa.RecordBatch.from_arrays(
                        [c.filter(pa.array(keep)) for c in batch.columns[:2]], names=["a", "b"]
                    )

        x = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("y"))
        rows = likely.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return rows.mapInArrow(compare, "a long, b long")

    def lists(self) -> DataFrame:
        """``o, h, rid, n, place``: postings of two nodes or more.

        What stands in a list of more than ``common`` is put in the exact order of rarity
        among its like (``o`` is 1). Places of the two orders are not compared.
        """

        def shared(postings: DataFrame, order: int) -> DataFrame:
            sizes = postings.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
            return postings.join(sizes, "h").select(F.lit(order).alias("o"), "h", "rid", "n", "place", "m")

        first = written(shared(self.postings(), 0), "lists")
        crowd = first.where(F.col("m") > self.common).select("rid").distinct()
        few = first.where(F.col("m") <= self.common)
        if crowd.isEmpty():
            return few.drop("m")
        rare = self._kept("rarest", lambda: self._rarest_first(crowd))
        return few.unionByName(shared(rare, 1)).drop("m")

    def links(self, pivot_rounds: int = 2) -> DataFrame:
        """Links (a, b) between nodes that make the same classes as all links do.

        First each node meets one pivot only, whatever its lists are; that links nearly all
        of a group of copies. Then the nodes of different classes meet the pivots of each list,
        which leave the list, as all others of it have met them, and at last what is left. A
        pair that was compared in one step is left out of the next. A long list has several
        pivots, as in a group of near copies one is linked with a part of the others only.
        """
        lists = self._kept("lists", self.lists)
        labels = links = compared = None
        for step in range(pivot_rounds + 1):
            open_ = self._kept("open", lambda: _unlinked(lists, labels)) if step else lists.withColumn("label", F.col("rid"))
            if open_.isEmpty():
                break
            if step < pivot_rounds:
                # Few rarer shingles before it: that node is near the middle of a group of near copies and
                # has most links. Else by hash, which takes the same ones in most lists of a group.
                middle = F.struct(F.when(F.col("o") == 1, F.col("place")).otherwise(0), F.xxhash64("rid", F.lit(step)), "rid")
                if step:
                    first = Window.partitionBy("o", "h").orderBy(middle)
                    ranked = open_.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= PIVOTS)
                    pivots = ranked.where((F.col("_rank") == 1) | (F.col("_rank") * PIVOTS <= F.col("m"))).drop("_rank", "m")
                else:
                    pivots = open_.groupBy("o", "h").agg(
                        F.min_by(F.struct("rid", "n", "place", "label"), middle).alias("p")
                    ).select("o", "h", "p.*")
                met = open_.join(_second(pivots), ["o", "h"]).where("rid <> rid2")
                if step:
                    lists = open_.drop("label", "m").join(pivots.select("o", "h", "rid"), ["o", "h", "rid"], "left_anti")
            else:
                met = open_.join(_second(open_), ["o", "h"]).where("rid < rid2")
            pairs = self._possible(met.where("label <> label2"))
            if not step:
                nearest = F.struct(F.when(F.col("o") == 1, F.col("place2")).otherwise(0), F.xxhash64("rid2", F.lit(step)))
                pairs = pairs.groupBy("rid").agg(F.min_by("rid2", nearest).alias("rid2"))
            pairs = pairs.select(F.least("rid", "rid2").alias("a"), F.greatest("rid", "rid2").alias("b")).distinct()
            if compared is not None:
                pairs = pairs.join(compared, ["a", "b"], "left_anti")
            pairs = written(pairs, "pairs")
            compared = pairs if compared is None else compared.unionByName(pairs)
            found = self.verified(pairs)
            links = found if links is None else links.unionByName(found)
            if step < pivot_rounds:
                labels = components(links)
        return links if links is not None else self.nodes.select(F.col("rid").alias("a"), F.col("rid").alias("b")).limit(0)


def _unlinked(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists with the class of each node and their sizes (``m``), without lists that are of one class."""
    of_nodes = labels.select(F.col("node").alias("rid"), "label")
    known = lists.join(of_nodes, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    spread = known.groupBy("o", "h").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m")
    ).where("lo < hi")
    return known.join(spread.select("o", "h", "m"), ["o", "h"])


def _sized(rows: DataFrame) -> DataFrame:
    """``rows`` of a written table, to be broadcast if their counted number is small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``rid, h``: a row for each shingle of each set."""
    for batch in batches:
        for rid, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            h = np.frombuffer(blob, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), rid)), pa.array(h)], names=["rid", "h"])


POSTING = "h long, rid long, n int, place int"
_POSTING_SCHEMA = pa.schema([("h", pa.int64()), ("rid", pa.int64()), ("n", pa.int32()), ("place", pa.int32())])


def _postings_batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(f.type.to_pandas_dtype())) for x, f in zip(columns, _POSTING_SCHEMA)], schema=_POSTING_SCHEMA
    )


def _entries(lists: pa.ListArray, *names: str) -> tuple[np.ndarray, ...]:
    """The row of each entry of a column of lists of structs, then its fields; a null list has no entries."""
    inner = lists.flatten()
    lengths = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(lists)), lengths), *(inner.field(name).to_numpy().astype(np.int64) for name in names)


def _starts(owner: np.ndarray) -> np.ndarray:
    """For each entry of sorted owners the place of its owner's first one."""
    return np.searchsorted(owner, owner)


def _second(df: DataFrame) -> DataFrame:
    keys = ["o", "h"]
    return df.select(*keys, *[F.col(c).alias(f"{c}2") for c in df.columns if c not in keys])


def similar_classes(
    df: DataFrame,
    words: int = 4,
    percent: int = 85,
    id_column: str = "doc_id",
    text_column: str = "text",
    common: int = 32,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Two documents link when their sets' intersection is at least ``percent`` of the union;
    ``component_id`` is the smallest id reachable by links. A null, empty or blank text has no
    shingles and stands alone; fewer words than ``words`` are one shingle. Rows with the same id
    are documents of their own; a null id is larger than all others, and a class without any
    id has a null one. Other columns are ignored. ``common`` only decides how lists are
    worked on, not which links are found.
    """
    rule = Similarity(words, percent)
    with arrow_rows(df.sparkSession, BATCH):
        return kept(df.sparkSession, "classes", lambda: _classes(df, rule, id_column, text_column, common))


def _classes(df: DataFrame, rule: Similarity, id_column: str, text_column: str, common: int) -> DataFrame:
    join = Join(df, rule, id_column, text_column, common)
    labels = components(join.links())
    owners = join.docs.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least"))
    nodes = join.firsts.select("sid", F.col("first").alias("rid"))
    named = (
        nodes.join(labels.withColumnRenamed("node", "rid"), "rid", "left")
        .select("sid", F.coalesce("label", "rid").alias("label"))
        .join(owners, "sid")
    )
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = named.select("sid", "label").join(smallest, "label").select("sid", "component_id")
    docs = join.docs.select("doc_id", "n", "sid")
    return docs.join(classes, "sid", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(df: DataFrame, classes: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` without those whose class another id stands for.

    An id goes if none of its rows is its class's own; rows that repeat both id and
    text are one. Only the ids that go are joined with the texts: broadcast where their
    counted number is small, else by a join that Spark can split.
    """
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = written(
        classes.groupBy("doc_id").agg(F.max(own).alias("own"), F.count(F.lit(1)).alias("rows")), "ids"
    )
    gone = ids.where("NOT own").select(F.col("doc_id").alias("_gone"))
    kept = df.join(_sized(gone), F.col(id_column).eqNullSafe(F.col("_gone")), "left_anti")
    again = ids.where("own AND rows > 1").select(F.col("doc_id").alias("_again"))
    if again.isEmpty():
        return kept
    again = _sized(again)
    same = F.col(id_column).eqNullSafe(F.col("_again"))
    single = kept.join(again, same, "left_anti")
    return single.unionByName(kept.join(again, same, "left_semi").dropDuplicates([id_column, text_column]))
