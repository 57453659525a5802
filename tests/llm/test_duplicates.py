"""Near-duplicate detection, substring dedup and decontamination against brute force."""

import numpy as np
import pytest

from tessera.llm import components, decontaminate, near_dedup, substring_dedup, words
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.data import documents, frame, odd_documents, ordered


@pytest.mark.parametrize("make", [documents, odd_documents])
def test_near_duplicates(spark, make):
    rows = make()
    got = near_dedup.near_duplicates(spark, frame(spark, rows)).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(brute.near_duplicates(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_every_link_of_a_spread_group_counts(spark):
    """Copies that are far from each other and near to few: no link between components is left out."""
    import random

    rng = random.Random(8)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(2, 9)):
            copy[rng.randrange(100)] = f"z{rng.randrange(12)}"
        rows.append((i, " ".join(copy)))
    got = near_dedup.near_duplicates(spark, frame(spark, rows)).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(brute.near_duplicates(rows))


def test_a_null_id_links_different_texts(spark):
    """Rows without an id connect documents that are not similar to each other, and near copies among themselves."""
    base = [f"b{i}" for i in range(100)]
    rows = [(1, " ".join([f"x{i}" for i in range(8)] + base[8:])), (2, " ".join(base[:-8] + [f"y{i}" for i in range(8)])), (None, " ".join(base)), (None, " ".join(base))]
    alone = [f"c{i}" for i in range(100)]
    rows += [(None, " ".join(alone)), (None, " ".join([*alone[:-3], "z"])), (3, " ".join(["u", "v", *alone[6:]])), (4, "quite another text of a few words")]
    got = near_dedup.near_duplicates(spark, frame(spark, rows)).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(brute.near_duplicates(rows))
    assert {r.doc_id: r.component_id for r in got if r.doc_id} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert all(r.component_id in (1, 3) and not r.kept for r in got if r.doc_id is None)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 3000).astype(np.uint64)
    x, y = np.unique(a[:2000]), np.unique(a[500:2500])
    share = (near_dedup.signature(x, 512) == near_dedup.signature(y, 512)).mean()
    assert abs(share - 1500 / 2500) < 0.08
    # one more shift is the ring turned on: coordinates are those of the second permutation, shifted
    assert (near_dedup.signature(x, 40)[:20] == near_dedup.signature(x, 20)).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (200, 200), (None, 3)]
    got = {r.node: r.root for r in components.components(spark, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("make", [documents, odd_documents])
def test_substring_dedup(spark, make):
    rows = make()
    got = substring_dedup.digests(substring_dedup.substring_dedup(spark, frame(spark, rows))).collect()
    assert ordered(got) == ordered(brute.substring_dedup(rows))


def test_decontamination(spark):
    rows = odd_documents()
    by_id = dict(documents())
    items = [(i * 7, " ".join((by_id[i] or "").split()[3:40])) for i in range(20)]
    items += [(500, None), (501, ""), (502, "one two three"), (503, "Éa"), (None, by_id[70]), (504, "a " * 11), (11, by_id[80]), (12, by_id[80]), (12, by_id[80])]
    frames = frame(spark, rows), frame(spark, items, "item_id long, text string")
    for blocks in ({}, {"block_windows": 300}):
        got = decontaminate.digests(decontaminate.contamination(spark, *frames, **blocks)).collect()
        assert ordered(got) == ordered(brute.contamination(rows, items))


def test_registered_queries_match_brute_force(spark):
    from tessera.llm.catalog import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op1_near_dedup"](spark, SF001).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(brute.near_duplicates(docs))
    assert ordered(QUERIES["op6_substring_dedup"](spark, SF001).collect()) == ordered(brute.substring_dedup(docs))
    assert ordered(QUERIES["op10_decontaminate"](spark, SF001).collect()) == ordered(brute.contamination(docs, items))


def test_queries_equal_their_sql(spark):
    from tessera.llm.catalog import ORACLE
    from tools.oracle_check import check

    got = check(spark, SF001, sorted(ORACLE))
    assert {k: v["status"] for k, v in got.items()} == dict.fromkeys(ORACLE, "match"), got


def test_empty_tables(spark):
    empty = frame(spark, documents()).where("false")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert near_dedup.near_duplicates(spark, empty).count() == 0
    assert substring_dedup.digests(substring_dedup.substring_dedup(spark, empty)).count() == 0
    assert decontaminate.contamination(spark, empty, items).count() == 0
    full = frame(spark, documents())
    assert decontaminate.contamination(spark, full, items.where("false")).where("n_hit = 0").count() == len(documents())


def test_words_of_columns():
    import pyarrow as pa

    texts = [None, "", "Ab ab\tAB\x0bé", "  x  ", "日本 a", "ab"]
    got = []
    for block in words.blocks(pa.array(texts), words.LOWER_WORDS, most=4):
        raw = block.data.tobytes()
        got += [[raw[a:b].decode() for a, b in zip(block.starts[i:j], block.ends[i:j])] for i, j in zip(block.first[:-1], block.first[1:])]
    assert got == [brute.blank_words(t) for t in texts]
    one = next(words.blocks(pa.array(["Ab cd ab cd aB CD"]), words.LOWER_WORDS))
    assert len(set(one.hashes.tolist())) == 2
    pairs = words.runs(one.hashes, 2)
    assert pairs[0] == pairs[2] == pairs[4] and pairs[1] == pairs[3] != pairs[0]
