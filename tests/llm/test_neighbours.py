import numpy as np
import pytest

from threadlake.llm import neighbours
from threadlake.llm.neighbours import build_index, nearest_of_rows, search


def brute(vectors, query, k, own=None):
    scores = [(-float(np.dot(np.float64(v), np.float64(query))), i, p) for p, (i, v) in enumerate(vectors) if p != own]
    return sorted(scores)[:k]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(3)


def random_rows(n, dimension=16, seed=0):
    rng = np.random.default_rng(seed)
    # Norms differ, so that the largest product is not the smallest angle.
    rows = rng.normal(size=(n, dimension)).astype(np.float32) * rng.uniform(0.5, 2, (n, 1)).astype(np.float32)
    return [(i, row.tolist(), 1) for i, row in enumerate(rows)]


def test_graph_search_finds_the_nearest(spark):
    rows = random_rows(900)
    got = nearest_of_rows(
        frame(spark, rows), every=20, k=10, block=64, starts=3, rounds=3
    ).collect()
    vectors = [(i, v) for i, v, _ in rows]
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == {i for i, _, _ in rows if i % 20 == 0}
    hits = 0
    for query, answers in found.items():
        answers.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in answers] == list(range(1, 11))
        assert query not in {r.vec_id for r in answers}
        assert [(-r.score, r.vec_id) for r in answers] == sorted((-r.score, r.vec_id) for r in answers)
        for r in answers:
            assert r.score == pytest.approx(np.dot(np.float64(rows[r.vec_id][1]), np.float64(rows[query][1])), rel=1e-12)
        hits += len({r.vec_id for r in answers} & {i for _, i, _ in brute(vectors, rows[query][1], 10, query)})
    assert hits / (10 * len(found)) >= 0.9


def test_descent_does_the_work_at_small_sizes_too(spark, monkeypatch):
    rounds, improve = [], neighbours._improve
    monkeypatch.setattr(neighbours, "_improve", lambda *a: rounds.append(a) or improve(*a))
    rows = random_rows(900)
    index = build_index(frame(spark, rows), rounds=2)
    names = {r.node: r.vec_id for r in index.nodes.select("node", "vec_id").collect()}
    plain = np.array([v for _, v, _ in rows])

    def recall(graph):
        hits = 0
        for r in graph.select("node", "ids").collect():
            away = ((plain - plain[names[r.node]]) ** 2).sum(axis=1)
            away[names[r.node]] = np.inf
            hits += len({names[i] for i in r.ids[:10]} & set(np.argsort(away)[:10].tolist()))
        return hits / (10 * len(rows))

    assert len(rounds) == 2
    assert recall(rounds[0][0]) < recall(index.graph)
    assert recall(index.graph) >= 0.9


def test_one_vector_of_a_far_larger_norm(spark):
    rows = random_rows(900)
    rows[7] = (7, (np.float32(rows[7][1]) * 10_000).tolist(), 1)
    got = nearest_of_rows(frame(spark, rows), every=20, k=10, block=64, starts=3, rounds=3).collect()
    vectors = [(i, v) for i, v, _ in rows]
    queries = {r.query_id for r in got}
    found = {(r.query_id, r.vec_id) for r in got}
    want = {(q, i) for q in queries for _, i, _ in brute(vectors, rows[q][1], 10, q)}
    assert len(found & want) / len(want) >= 0.9
    # In the graph itself, near rows stay near.
    graph = build_index(frame(spark, rows), block=64, starts=3, rounds=3, k=10)
    names = {r.node: r.vec_id for r in graph.nodes.select("node", "vec_id").collect()}
    plain = np.array([v for _, v in vectors])
    hits = 0
    for r in graph.graph.collect():
        own = names[r.node]
        away = ((plain - plain[own]) ** 2).sum(axis=1)
        away[own] = np.inf
        hits += own != 7 and len({names[i] for i in r.ids} & set(np.argsort(away)[:10].tolist()))
    assert hits / (10 * 899) >= 0.8


def test_small_tables_are_exact_with_ties_and_odd_rows(spark):
    good = [(i, v, 0) for i, v, _ in random_rows(30, 4)]
    good += [(40, [1.0, 1.0, 0.0, 0.0], 0), (60, [1.0, 1.0, 0.0, 0.0], 0), (60, [1.0, 1.0, 0.0, 0.0], 0), (None, [5.0, 0.0, 0.0, 0.0], 0)]
    odd = [
        (100, None, 0), (120, [], 0), (140, [0.0] * 4, 0), (160, [1.0, None, 0.0, 0.0], 0),
        (180, [float("nan"), 1.0, 0.0, 0.0], 0), (200, [float("inf"), 1.0, 0.0, 0.0], 0), (220, [1.0, 2.0], 0),
    ]
    got = nearest_of_rows(frame(spark, good + odd), every=20, k=5).collect()
    vectors = [(i if i is not None else 10**9, v) for i, v, _ in good]
    want = []
    for place, (i, v, _) in enumerate(good):
        if i is not None and i % 20 == 0:
            want += [(i, n, j) for n, (_, j, _) in enumerate(brute(vectors, v, 5, place), 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id if r.vec_id is not None else 10**9) for r in got) == sorted(want)


def test_queries_from_outside_and_few_rows(spark):
    rows = random_rows(3, 4)
    index = build_index(frame(spark, rows))
    vector = np.array([1.0, 0.5, 0.0, -1.0])
    asked = spark.createDataFrame([(0, 77, None, bytearray(vector.tobytes()))], "query long, query_id long, own long, vec binary")
    got = search(index, asked, k=5).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [
        (n, i) for n, (_, i, _) in enumerate(brute([(i, v) for i, v, _ in rows], vector, 5), 1)
    ]
    one = frame(spark, rows[:1])
    assert nearest_of_rows(one, every=1).count() == 0
    assert nearest_of_rows(one.limit(0), every=1).count() == 0


def test_equal_products_go_to_the_smaller_ids(spark):
    rows = [(i, [1.0, 2.0, 0.5, 0.25], 0) for i in range(199, -1, -1)]
    got = nearest_of_rows(frame(spark, rows).coalesce(1), every=100, k=20).collect()
    found = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100)}
    assert found == {0: list(range(1, 21)), 100: list(range(20))}


def test_nothing_is_left_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert len(nearest_of_rows(frame(spark, random_rows(40)), every=20, k=3).collect()) == 6
    assert {t.name for t in spark.catalog.listTables()} == before


def test_few_anchors_suffice(spark):
    """The graph finds what anchors of under 5 % of the rows do not stand near to."""
    rows = random_rows(1000, 8)
    df = frame(spark, rows)
    index = build_index(df, block=64, starts=3)
    assert len(index.anchor_nodes) <= 2 * 1000 // neighbours.ONE_IN
    few = index._replace(anchor_nodes=index.anchor_nodes[:20], anchor_vectors=index.anchor_vectors[:20])
    queries = index.nodes.where("vec_id % 50 = 0").selectExpr("node AS query", "vec_id AS query_id", "node AS own", "vec")
    found = {(r.query_id, r.vec_id) for r in search(few, queries, 10).collect()}
    vectors = [(i, v) for i, v, _ in rows]
    want = {(q, i) for q in range(0, 1000, 50) for _, i, _ in brute(vectors, rows[q][1], 10, q)}
    assert len(found & want) / len(want) >= 0.9
    spark.sql(f"DROP TABLE {index.table}")
