"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

Nearness is the largest inner product. Index vectors get one more component that makes
all norms equal, so that near in the graph means a large product for any query. The graph
starts from blocks of rows that share their nearest anchors and is improved by joins
of neighbours of neighbours until few edges change. A search starts at the best anchors (and
at the query's own row, if it is in the index) and follows edges from the best
nodes found so far. Vectors with a half-precision direction choose edges; results are
scored exactly.
The searchable form of the graph is a table bucketed by node that holds each node's
neighbours with their vectors, so that a step of a search shuffles the followed nodes only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlake.llm.common import arrow_rows, written
from threadlake.session import shared_folder

ANCHORS = 256  # the bounded sample that one start is fitted on
ONE_IN = 20  # of fewer rows, anchors are this share
GROUPS = 2048  # rows of an Arrow batch: each holds the vectors of up to some 64 nodes
EDGES = "node long, ids array<long>, sims array<float>"
_EDGE_SCHEMA = pa.schema(
    [("node", pa.int64()), ("ids", pa.list_(pa.int64())), ("sims", pa.list_(pa.float32()))]
)


class Index(NamedTuple):
    """``nodes``: node, vec_id, vec (original), half (direction in half
    precision and share of the largest norm), norm;
    ``graph``: node, ids, sims; ``table``: name of a table of node, ids, vectors of its neighbours
    in both directions, bucketed by node, to be dropped after the last search; and the anchors' nodes and extended vectors."""

    nodes: DataFrame
    graph: DataFrame
    table: str
    anchor_nodes: np.ndarray
    anchor_vectors: np.ndarray
    dimension: int


def _data(column: pa.Array) -> np.ndarray:
    """The bytes of a binary column without nulls, where Arrow holds them."""
    if not len(column):
        return np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int32)
    return np.frombuffer(data, np.uint8)[places[column.offset] : places[column.offset + len(column)]]


def _stack(column: pa.Array, kind: str) -> np.ndarray:
    """A binary column of equally long vectors as a matrix."""
    return _data(column).view(kind).reshape(len(column), -1).astype(np.float32)


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows ``[x, d]`` of a binary column that ``prepare`` made.

    ``x`` is the vector divided by the largest norm, ``1 - d`` the component that makes its
    norm 1. Kept as ``d``, it leaves the digits of ``x`` alone however small ``x`` is.
    """
    raw = _data(column).reshape(len(column), -1)
    unit, norm = (np.ascontiguousarray(part).view(kind) for part, kind in ((raw[:, :-8], "<f2"), (raw[:, -8:], "<f8")))
    x = unit.astype(np.float64) * norm
    square = np.minimum(1, (x * x).sum(axis=1, keepdims=True))
    return np.c_[x, square / (1 + np.sqrt(1 - square))].astype(np.float32)


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order: equal rows have equal products."""
    return (rows * query).sum(axis=1)


def _nearness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, less 1, of vectors whose norms the added components make equal."""
    return a @ b.T - a[:, -1:] - b[:, -1]


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _usable(column: str):
    """Non-null vectors without null or non-finite components that are not zero."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~bad & F.exists(column, lambda x: x != 0)


def prepare(df: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int, float]:
    """Rows that take part, with node numbers and extended vectors; dimension and largest norm.

    Nodes are numbered in the order of their ids (null first), so that of equally near ones
    the smaller node has the smaller id. Where lengths differ, the most frequent one takes part (of equally frequent, the longer).
    """
    rows = df.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vec"),
    ).where(_usable("vec"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    sizes = (
        rows.select(F.size("vec").alias("size"), norm.alias("norm"))
        .groupBy("size")
        .agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm"))
        .orderBy(F.desc("n"), F.desc("size"))
        .first()
    )
    if sizes is None:
        return rows, 0, 0.0
    dimension, largest = sizes["size"], float(sizes["norm"])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.asarray(batch.column(1).flatten()).reshape(-1, dimension)
            # Each row is scaled by itself: one row with a huge norm takes no digits from others.
            top = np.abs(raw).max(axis=1, keepdims=True)
            norm = top * np.sqrt(((raw / top) ** 2).sum(axis=1, keepdims=True))
            half, share = (raw / norm).astype("<f2"), (norm / largest).astype("<f8")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([row.tobytes() for row in raw.astype("<f8")], pa.binary()),
                    pa.array([a.tobytes() + b.tobytes() for a, b in zip(half, share)], pa.binary()),
                    pa.array(norm[:, 0]),
                ],
                names=["vec_id", "vec", "half", "norm"],
            )

    # The place tells apart rows of one id, so that a range of them can be cut anywhere.
    ordered = (
        rows.where(F.size("vec") == dimension)
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange("vec_id", "place")
        .sortWithinPartitions("vec_id", "place")
        .drop("place")
    )
    chosen = ordered.mapInArrow(extend, "vec_id long, vec binary, half binary, norm double")
    nodes = chosen.select(F.monotonically_increasing_id().alias("node"), "vec_id", "vec", "half", "norm")
    return written(nodes, "nodes"), dimension, largest


def _best(owner: np.ndarray, ids: np.ndarray, sims: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best entries of each owner; of equal ones the smaller id."""
    order = np.lexsort((ids, -sims, owner))
    sorted_owner = owner[order]
    first = np.flatnonzero(np.r_[True, sorted_owner[1:] != sorted_owner[:-1]])
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[rank < k]


def _block_edges(nodes: np.ndarray, vectors: np.ndarray, k: int, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest of each row within its block, some rows at a time."""
    k = min(k, len(nodes) - 1)
    for at in range(0, len(nodes) if k else 0, rows):
        sims = _nearness(vectors[at : at + rows], vectors)
        here = np.arange(len(sims))
        sims[here, at + here] = -np.inf
        top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        offsets = np.arange(len(sims) + 1) * k
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(nodes[at : at + rows]),
                _lists(offsets, nodes[top].ravel()),
                _lists(offsets, np.take_along_axis(sims, top, 1).ravel()),
            ],
            schema=_EDGE_SCHEMA,
        )


def _start(nodes: DataFrame, anchors: np.ndarray, k: int, block: int, partitions: int) -> DataFrame:
    """Edges within blocks of rows with the same nearest anchors.

    Rows are dealt by range of (nearest anchor, second, nearness, node), so that a place
    where a third of all rows lie is as many blocks as it needs.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = _nearness(_vectors(batch.column(1)), anchors)
            first = sims.argmax(axis=1)
            near = sims[np.arange(len(sims)), first].copy()
            sims[np.arange(len(sims)), first] = -np.inf
            cell = first * len(anchors) + sims.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(cell), pa.array(near)], names=["node", "half", "cell", "near"]
            )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.r_[ids, batch.column(0).to_numpy()]
            more = _vectors(batch.column(1))
            vectors = more if vectors is None else np.r_[vectors, more]
            # The last block of a task is between one and two blocks long, never shorter.
            while len(ids) >= 2 * block:
                yield from _block_edges(ids[:block], vectors[:block], k)
                ids, vectors = ids[block:], vectors[block:]
        if len(ids):
            yield from _block_edges(ids, vectors, k)

    cells = nodes.select("node", "half").mapInArrow(keyed, "node long, half binary, cell long, near float")
    dealt = cells.repartitionByRange(partitions, "cell", "near", "node").sortWithinPartitions("cell", "near", "node")
    return dealt.select("node", "half").mapInArrow(blocks, EDGES)


def _exploded(graph: DataFrame) -> DataFrame:
    return graph.select("node", F.explode(F.arrays_zip("ids", "sims")).alias("e")).select(
        "node", F.col("e.ids").alias("id"), F.col("e.sims").alias("sim")
    )


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """One list of the ``k`` best distinct edges for each node, from a few lists of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            outer = batch.column(1)
            inner = outer.values.field("ids")
            ids = inner.values.to_numpy()
            sims = outer.values.field("sims").values.to_numpy()
            bounds = inner.offsets.to_numpy()[outer.offsets.to_numpy()]
            nodes = np.repeat(batch.column(0).to_numpy(), np.diff(bounds))
            yield _best_lists(nodes, ids, sims, k)

    grouped = lists.groupBy("node").agg(F.collect_list(F.struct("ids", "sims")).alias("lists"))
    return grouped.mapInArrow(run, EDGES)


def _best_lists(nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray, k: int) -> pa.RecordBatch:
    """Edges as one list a node of its ``k`` best distinct ones."""
    names, owner = np.unique(nodes, return_inverse=True)
    # The same pair may differ in its last bit between blocks: the first one counts.
    order = np.lexsort((ids, owner))
    same = np.r_[False, (np.diff(ids[order]) == 0) & (np.diff(owner[order]) == 0)]
    owner, ids, sims = (x[order[~same]] for x in (owner, ids, sims))
    best = _best(owner, ids, sims, k)
    offsets = np.r_[0, np.cumsum(np.bincount(owner[best], minlength=len(names)))]
    return pa.RecordBatch.from_arrays(
        [pa.array(names), _lists(offsets, ids[best]), _lists(offsets, sims[best])], schema=_EDGE_SCHEMA
    )


def _backward(edges: DataFrame, most: int, seed: int) -> DataFrame:
    """``node, id`` turned round, at most ``most`` a node, taken by a hash."""
    any_order = Window.partitionBy("node").orderBy(F.xxhash64("node", "id", F.lit(seed)), "id")
    turned = edges.select(F.col("id").alias("node"), F.col("node").alias("id"))
    return turned.withColumn("_rank", F.row_number().over(any_order)).where(F.col("_rank") <= most).drop("_rank")


def _improve(graph: DataFrame, nodes: DataFrame, k: int, join_size: int, seed: int) -> DataFrame:
    """One round: candidate edges between the neighbours of each node.

    A node meets about ``join_size`` of its neighbours and as many of the nodes it is a
    neighbour of, others in each round. A pair is sent on only if it is better than
    the worst edge one of them has.
    """
    edges = _exploded(graph).select("node", "id")
    limit = F.element_at("sims", -1)
    worst = graph.select(
        F.col("node").alias("id"),
        F.when(F.size("ids") >= k, limit).otherwise(F.lit(-3.0)).cast("float").alias("worst"),
    )
    share = F.pmod(F.xxhash64("node", "id", F.lit(seed)), F.lit(1024)) < 1024 * join_size // k
    pairs = edges.where(share).unionByName(_backward(edges, join_size, seed)).distinct()
    vectors = nodes.select(F.col("node").alias("id"), "half").join(worst, "id")
    groups = (
        pairs.join(vectors, "id")
        .groupBy("node")
        .agg(F.collect_list(F.struct("id", "half", "worst")).alias("e"))
        .select("e")
    )

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy()
            inner = lists.values
            ids = inner.field("id").to_numpy()
            worst_of = inner.field("worst").to_numpy(zero_copy_only=False)
            vectors = _vectors(inner.field("half"))
            members, others, sims_of = [], [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                sims = _nearness(vectors[a:b], vectors[a:b])
                np.fill_diagonal(sims, -np.inf)
                rows, columns = np.nonzero(sims > worst_of[a:b, None])
                members.append(ids[a + rows])
                others.append(ids[a + columns])
                sims_of.append(sims[rows, columns])
            # What a batch found for a node is one list of its best, before anything is shuffled.
            if sum(map(len, members)):
                yield _best_lists(*map(np.concatenate, (members, others, sims_of)), k)

    return groups.mapInArrow(local, EDGES)


def _links(graph: DataFrame, nodes: DataFrame, most: int, count: int) -> str:
    """Name of a table of each node's neighbours in both directions with their vectors, bucketed by node."""
    edges = _exploded(graph).select("node", "id")
    pairs = edges.unionByName(_backward(edges, most, 0)).distinct()
    buckets = max(8, min(4096, count // 8192))
    halves = nodes.select(F.col("node").alias("id"), "half")
    grouped = (
        pairs.join(halves, "id")
        .repartition(buckets, "node")
        .groupBy("node")
        .agg(F.collect_list(F.struct("id", "half")).alias("e"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            halves = lists.values.field("half")
            # A list's vectors lie next to each other already.
            width = len(_data(halves)) // max(1, len(halves))
            blobs = pa.Array.from_buffers(
                pa.binary(), len(lists),
                [None, pa.py_buffer((offsets * width).astype(np.int32)), pa.py_buffer(_data(halves))],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(lists.offsets, lists.values.field("id")),
                    blobs,
                ],
                names=["node", "ids", "vectors"],
            )

    spark = graph.sparkSession
    name = f"threadlake_links_{uuid.uuid4().hex}"
    (
        grouped.mapInArrow(run, "node long, ids array<long>, vectors binary")
        .write.bucketBy(buckets, "node")
        .option("path", f"{shared_folder(spark)}/llm/{name}")
        .format("parquet")
        .saveAsTable(name)
    )
    return name


def build_index(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 32,
    starts: int = 6,
    rounds: int = 12,
    join_size: int = 16,
    block: int = 256,
    changed: float = 0.02,
) -> Index | None:
    """The neighbour graph of all rows that take part; None if there are none.

    Rows take part unless their vector is null, zero, or holds null or non-finite
    components. Repeated rows, also of one id, are nodes each. Rounds end early when
    fewer than ``changed`` of all edges were replaced. Anchors are at most ``ANCHORS`` for
    each start, and one in ``ONE_IN`` of fewer rows. Where vectors differ in
    length, only those of the most frequent length take part.
    """
    nodes, dimension, _ = prepare(df, id_column, vector_column)
    if not dimension:
        return None
    count = nodes.count()
    share = max(starts, count // ONE_IN)
    sampled = nodes.orderBy(F.xxhash64("node"), "node").limit(min(ANCHORS * starts, share)).select("node", "half").collect()
    anchor_nodes = np.array([r["node"] for r in sampled], np.int64)
    anchors = _vectors(pa.array([bytes(r["half"]) for r in sampled], pa.binary()))
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(1, min(default, count // block))
    begun = [_start(nodes, anchors[i % len(anchors) :: starts], k, block, partitions) for i in range(starts)]
    lists = begun[0]
    for more in begun[1:]:
        lists = lists.unionByName(more)
    graph = written(_merged(lists, k), "graph")
    for seed in range(rounds):
        found = _improve(graph, nodes, k, join_size, seed)
        before, graph = graph, written(_merged(graph.unionByName(found), k), "graph")
        kept, edges = (
            graph.join(before.select("node", F.col("ids").alias("_before")), "node", "left")
            .agg(F.sum(F.size(F.array_intersect("ids", F.coalesce("_before", F.array())))), F.sum(F.size("ids")))
            .first()
        )
        if not edges or kept > (1 - changed) * edges:
            break
    # Rows of the largest norms are far from all others in the graph, and often the nearest.
    longest = nodes.orderBy(F.desc("norm"), "node").limit(min(ANCHORS, share)).select("node", "half").collect()
    first = {int(n): v for n, v in zip(anchor_nodes, anchors)}
    first |= dict(zip((r["node"] for r in longest), _vectors(pa.array([bytes(r["half"]) for r in longest], pa.binary()))))
    links = _links(graph, nodes, k, count)
    return Index(nodes, graph, links, np.array(list(first), np.int64), np.stack(list(first.values())), dimension)


STATE = "query long, asked binary, ids array<long>, sims array<float>, followed array<boolean>, now array<long>"
_STATE_SCHEMA = pa.schema(
    [
        ("query", pa.int64()), ("asked", pa.binary()), ("ids", pa.list_(pa.int64())),
        ("sims", pa.list_(pa.float32())), ("followed", pa.list_(pa.bool_())), ("now", pa.list_(pa.int64())),
    ]
)


def _state_row(query, asked, ids, sims, followed, pool: int, width: int) -> tuple:
    """The best ``pool`` nodes, and the ``width`` best of them that are followed next."""
    order = np.lexsort((ids, -sims))[:pool]
    ids, sims, followed = ids[order], sims[order], followed[order]
    now = np.flatnonzero(~followed)[:width]
    followed[now] = True
    return query, asked, ids, sims, followed, ids[now]


def search(
    index: Index, queries: DataFrame, k: int = 20, pool: int = 256, width: int = 32, steps: int = 5
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each query.

    ``queries`` has ``query`` (a number of its own), ``query_id``, ``own`` (the query's node,
    or null if it is no row of the index) and ``vec`` (doubles as bytes). In each step
    the ``width`` best nodes of a pool of ``pool`` that were not followed yet are. Of equal
    products the smaller id comes first. Repeated query ids are queries of their own.
    """
    shared = queries.sparkSession.sparkContext.broadcast((index.anchor_nodes, index.anchor_vectors))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, anchors = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _stack(batch.column(1), "<f8")
            rows = []
            for query, asked, own, vector in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), vectors
            ):
                ids, sims = nodes, _products(anchors[:, :-1], vector)
                if own is not None:
                    # The own node stands first, and once, whatever its product is.
                    other = nodes != own
                    ids, sims = np.r_[own, nodes[other]], np.r_[np.float32(np.inf), sims[other]]
                fresh = np.zeros(len(ids), bool)
                rows.append(_state_row(query, asked, ids, sims, fresh, pool, width))
            yield _state_batch(rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_out, sims_out = [], []
            ids_of = batch.column(2)
            for asked, ids, blob in zip(batch.column(1), ids_of, batch.column(3)):
                ids = ids.values.to_numpy()
                width_of = len(blob.as_buffer()) // max(1, len(ids))
                offsets = np.arange(len(ids) + 1, dtype=np.int32) * width_of
                column = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), blob.as_buffer()])
                sims = _products(_vectors(column)[:, :-1], np.frombuffer(asked.as_buffer(), "<f8").astype(np.float32))
                best = np.lexsort((ids, -sims))[: 2 * width]
                ids_out.append(ids[best])
                sims_out.append(sims[best])
            if ids_out:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(ids_out, pa.list_(pa.int64())),
                        pa.array(sims_out, pa.list_(pa.float32())),
                    ],
                    schema=_EDGE_SCHEMA,
                )

    def renew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                found = row["found"] or []
                ids = np.concatenate([np.array(x, np.int64) for x in (row["ids"], *(f["ids"] for f in found))])
                sims = np.concatenate([np.array(x, np.float32) for x in (row["sims"], *(f["sims"] for f in found))])
                followed = np.zeros(len(ids), bool)
                followed[: len(row["ids"])] = row["followed"]
                _, first = np.unique(ids, return_index=True)  # the pool's own entries come first
                rows.append(
                    _state_row(row["query"], row["asked"], ids[first], sims[first], followed[first], pool, width)
                )
            if rows:
                yield _state_batch(rows)

    def _state_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_STATE_SCHEMA)], schema=_STATE_SCHEMA
        )

    state = written(queries.select("query", "vec", "own").mapInArrow(begin, STATE), "pool")
    for _ in range(steps):
        follow = state.select("query", "asked", F.explode("now").alias("node"))
        met = follow.join(queries.sparkSession.table(index.table), "node").select("query", "asked", "ids", "vectors")
        hits = met.mapInArrow(score, "node long, ids array<long>, sims array<float>")
        found = hits.groupBy(F.col("node").alias("query")).agg(
            F.collect_list(F.struct("ids", "sims")).alias("found")
        )
        state = written(state.join(found, "query", "left").mapInArrow(renew, STATE), "pool")
    originals = index.nodes.select(F.col("node").alias("id"), "vec_id", "vec")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_data(batch.column(i)).view("<f8").reshape(batch.num_rows, -1) for i in (2, 3))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array((a * b).sum(axis=1))], names=["query", "vec_id", "score"]
                )

    # Half precision blurs the order a little: some more than k are scored exactly.
    likely = state.select("query", "asked", F.explode(F.slice("ids", 1, 2 * k + 1)).alias("id"))
    about = queries.select("query", "query_id", "own")
    pairs = likely.join(about, "query").where("own IS NULL OR own <> id").join(originals, "id")
    rows = pairs.select("query", "vec_id", "vec", "asked").mapInArrow(
        exact, "query long, vec_id long, score double"
    )
    # Repeated query ids are queries of their own; the number keeps them apart.
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = rows.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return top.join(about.select("query", "query_id"), "query").select("query_id", "rank", "vec_id", "score")


def nearest_of_rows(
    df: DataFrame, every: int, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 20, **options
) -> DataFrame:
    """The ``k`` nearest other rows of each row whose id is divisible by ``every``.

    Rows of a null id are found, but ask nothing. Repeated rows of one id ask each, and find
    each other. Vectors that take no part (see ``build_index``) neither ask nor are found.
    """
    spark = df.sparkSession
    with arrow_rows(spark, GROUPS):
        index = build_index(df, id_column, vector_column, **options)
        if index is None:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        queries = index.nodes.where(F.col("vec_id") % every == 0).select(
            F.col("node").alias("query"), F.col("vec_id").alias("query_id"), F.col("node").alias("own"), "vec"
        )
        found = search(index, queries, k)
    # The steps of the search are written; nothing reads the table any more.
    spark.sql(f"DROP TABLE {index.table}")
    return found
