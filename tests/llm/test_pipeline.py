import importlib

import pytest

import corpus_pipeline
from threadlake.llm import queries
from threadlake.llm.oracles import ORACLES

check_oracle = importlib.import_module("check_oracle")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, connection, name):
    outcome, _, _ = check_oracle.compare(spark, connection, name, SF)
    assert outcome.startswith("ok"), outcome


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 11))


def shingles(text, size):
    words = text.lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def test_stages_do_what_they_say(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        seen[name] = (before, docs)
    texts = {r.doc_id: r.text for r in documents.collect()}

    def ids(df):
        return [r.doc_id for r in df.select("doc_id").collect()]

    before, good = seen["quality classifier"]
    assert good.schema == documents.schema
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(ids(good))
    assert all(i in kept for i, quality in labels.items() if quality == 1)
    assert len(kept) < len(texts)

    before, single = seen["n-gram Jaccard join"]
    left = ids(single)
    assert single.schema == documents.schema and len(set(left)) == len(left)
    sets = {i: shingles(texts[i], 5) for i in ids(before)}

    def alike(i, j):
        common = len(sets[i] & sets[j])
        return common and 100 * common >= 80 * len(sets[i] | sets[j])

    group = {i: i for i in sets}
    changed = True
    pairs = [(i, j) for i in sets for j in sets if i < j and alike(i, j)]
    while changed:
        changed = False
        for i, j in pairs:
            least = min(group[i], group[j])
            if group[i] != least or group[j] != least:
                group[i] = group[j] = least
                changed = True
    assert sorted(left) == sorted(set(group.values()))

    before, clean = seen["benchmark decontamination"]
    hit = {r.doc_id for r in queries.decontaminated(spark, SF).collect() if r.contaminated}
    assert sorted(ids(clean)) == sorted(i for i in ids(before) if i not in hit)

    before, packed = seen["best-fit packing"]
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(ids(before))


def test_run_gives_the_last_stages_rows(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packed.count() > 0
