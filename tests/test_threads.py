import random

import pytest

from helpers import rows
from threadlake.operators.threads import expand_threads

ITEMS = "id bigint, type string, kids array<bigint>"


def items(spark, tree, **types):
    data = [(i, types.get(f"t{i}", "comment"), kids) for i, kids in tree.items()]
    return spark.createDataFrame(data, ITEMS)


def roots(spark, **kids):
    return spark.createDataFrame([(int(k[1:]), v) for k, v in kids.items()], "id bigint, kids array<bigint>")


def walk(spark, start, tree, *columns, **more):
    types = {k: more.pop(k) for k in list(more) if k.startswith("t")}
    return rows(expand_threads(start, items(spark, tree, **types), **more), *(columns or ("id",)))


CHAIN = {201: [301], 301: [401], 401: None}


def test_depth_limit(spark):
    start = roots(spark, r100=[201])
    assert walk(spark, start, CHAIN, max_depth=2) == [(201,), (301,)]
    assert walk(spark, start, CHAIN, "id", "depth", max_depth=9) == [(201, 0), (301, 1), (401, 2)]


def test_several_branches_and_roots(spark):
    tree = {201: [301, 302], 202: [303], 301: [], 302: None, 303: []}
    start = roots(spark, r100=[201], r101=[202])
    assert walk(spark, start, tree, "root_id", "id") == [(100, 201), (100, 301), (100, 302), (101, 202), (101, 303)]


def test_missing_and_other_items_end_their_branch(spark):
    start = roots(spark, r100=[201, 202, 203])
    assert walk(spark, start, {201: None, 203: None}) == [(201,), (203,)]
    tree = {201: None, 202: [301], 203: None, 301: None}
    assert walk(spark, start, tree, t202="poll") == [(201,), (203,)]


def test_no_replies(spark):
    found = expand_threads(roots(spark, r100=None, r101=[]), items(spark, CHAIN))
    assert found.count() == 0
    assert found.columns == ["id", "type", "kids", "root_id", "depth", "path"]


def test_path_gives_reading_order(spark):
    tree = {1: [3, 4], 2: None, 3: None, 4: None}
    found = expand_threads(roots(spark, r100=[1, 2]), items(spark, tree))
    assert [row.id for row in found.orderBy("root_id", "path").collect()] == [1, 3, 4, 2]


def test_shared_and_circular_replies_repeat_unless_once(spark):
    tree = {1: [2], 2: [1]}
    start = roots(spark, r100=[1])
    assert len(walk(spark, start, tree, max_depth=5)) == 5
    assert walk(spark, start, tree, max_depth=5, once_per_root=True) == [(1,), (2,)]
    diamond = {1: [3], 2: [3], 3: None}
    assert walk(spark, roots(spark, r9=[1, 2]), diamond) == [(1,), (2,), (3,), (3,)]
    once = walk(spark, roots(spark, r9=[1, 2]), diamond, "id", "path", once_per_root=True)
    assert once == [(1, [0]), (2, [1]), (3, [0, 0])]


def test_no_table_is_left_behind(spark):
    walk(spark, roots(spark, r100=[201]), CHAIN)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("threadlake")]


@pytest.mark.parametrize("depth", [1, 3, 10])
def test_random_forest_against_recursion(spark, depth):
    draw = random.Random(depth)
    tree = {i: [k for k in range(i + 1, min(i + 6, 130)) if draw.random() < 0.35] for i in range(1, 120)}
    kinds = {i: draw.choice(["comment"] * 6 + ["poll"]) for i in tree}
    start = {1000 + r: [draw.randint(1, 120) for _ in range(3)] for r in range(4)}

    def visit(ids, level, path):
        if level == depth:
            return
        for place, i in enumerate(ids):
            if kinds.get(i) == "comment":
                yield i, level, [*path, place]
                yield from visit(tree[i], level + 1, [*path, place])

    want = sorted(
        ((r, i, d, p) for r, kids in start.items() for i, d, p in visit(kids, 0, [])), key=repr
    )
    found = expand_threads(
        spark.createDataFrame(list(start.items()), "id bigint, kids array<bigint>"),
        spark.createDataFrame([(i, kinds[i], tree[i]) for i in tree], ITEMS),
        max_depth=depth,
    )
    assert rows(found, "root_id", "id", "depth", "path") == want
