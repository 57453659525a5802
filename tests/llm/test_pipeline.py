"""The pipeline's stages against plain Python, each on what the one before kept."""

import base64
import os
import random
import string

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import language_id
from tessera.llm.stage import written
from tessera.session import shared_dir
from tests.conftest import SF001, SF01
from tests.llm import brute
from tests.llm.data import documents, frame, ordered


def expected(rows, items, kept):
    """Rows (doc_id, text) after each of the middle stages, then the encoder's digests; ``kept`` passed the first."""
    rows = [r for r in rows if r in kept]
    out = [list(rows)]
    rows = survivors(rows)
    out.append(list(rows))
    first = {}
    for d, t in rows:
        w = brute.blank_words(t)
        for i in range(len(w) - 49 if d is not None else 0):
            first[tuple(w[i : i + 50])] = min(d, first.get(tuple(w[i : i + 50]), d))
    cut = []
    for d, t in rows:
        w = brute.blank_words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 49 if d is not None else 0):
            if first[tuple(w[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        text = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else t
        if text or not any(gone):
            cut.append((d, text))
    out.append(cut)
    hit = brute.contamination(cut, items)
    rows = [r for r, h in zip(cut, hit) if not h[5]]
    out.append(list(rows))
    return out, brute.round_trip(rows, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))


def survivors(rows):
    """One row of each component of near duplicates (every pair is compared): the smallest id, null last."""
    rows = list(dict.fromkeys(rows))
    sets = [brute.shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d or 0)
        if find(i) not in best or key < best[find(i)][0]:
            best[find(i)] = (key, i)
    return [rows[i] for _, i in best.values()]


def staged(spark, docs, sf_dir):
    """The written result of each stage."""
    for name, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"test-{name}")
        yield docs


def check(spark, docs, sf_dir):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = list(staged(spark, docs, sf_dir))
    stages, digests = expected(rows, items, {(r.doc_id, r.text) for r in got[0].collect()})
    for df, want in zip(got[:-1], stages, strict=True):
        assert df.columns == docs.columns
        assert ordered((r.doc_id, r.text) for r in df.collect()) == ordered(want)
    assert ordered(got[-1].collect()) == ordered(digests)
    return got


def test_stages_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = check(spark, docs, SF001)
    assert ordered(corpus_pipeline.run(spark, SF001).collect()) == ordered(got[-1].collect())


def test_stages_on_planted_cases(spark, scratch):
    path = scratch("pipeline")
    rows = [(d, t, "en", 0) for d, t in documents()]
    docs = frame(spark, rows, "doc_id long, text string, lang string, n_chars int")
    item = next(t for d, t in documents() if d == 5)
    spark.createDataFrame([(1, item), (2, None), (None, "zz")], "item_id long, text string").write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
    got = check(spark, docs, path)
    cut = [r for r in got[2].collect() if r.n_chars]
    assert cut and all(r.n_chars == len(r.text) for r in cut)  # n_chars follows texts that changed


def prose(rng, n):
    return " ".join("".join(rng.choice(["an", "the", "ing", "ou", "re", "sh", "ti", "on", "wh", "er"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_repeated_and_null_ids(spark, scratch):
    """Rows are told apart by id and text: other texts under a repeated id stay, copies under null ids go."""
    path, rng = scratch("pipeline-odd"), random.Random(1)
    spark.createDataFrame([], "item_id long, text string").write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
    a, b, c, d, e = (prose(rng, 80) for _ in range(5))
    rows = [(1, a, "en"), (1, a, "en"), (1, b, "en"), (2, a + " the", "en"), (None, a, "en"), (None, c, "en"), (None, c, "en"), (9, c + " the", "en"), (None, e, "en"), (None, e, "en"),
            (3, None, "en"), (4, "", None), (7, d, None), (None, None, None)]
    docs = frame(spark, rows, "doc_id long, text string, lang string")
    got = list(staged(spark, docs, path))
    after = got[1].select("doc_id", "text").collect()
    assert ordered(r for r in after if r.doc_id is not None) == ordered([(1, a), (1, b), (7, d), (9, c + " the")])
    assert [r.text for r in after if r.doc_id is None] == [e] and got[-1].count() == 5
    check(spark, docs, path)
    check(spark, docs.withColumn("lang", F.lit(None).cast("string")), path)  # nothing to learn from: all texts with a letter stay
    assert [df.count() for df in staged(spark, docs.where("false"), path)] == [0] * 5


def test_texts_of_no_language_go(spark, scratch):
    """Random strings, encoded bytes and code go, whatever their score; every document of the given table stays."""
    rng = random.Random(5)
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    junk = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(800)), base64.b64encode(rng.randbytes(3000)).decode(),
            " ".join("".join(rng.choice(string.printable) for _ in range(9)) for _ in range(90)), "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(500)),
            "\n".join(f"for (int i{k} = 0; i{k} < {k}; ++i{k}) {{ x[{k}] ^= (y->z_{k} << {k}) | 0x{k:04X}; }}" for k in range(60))]
    rows = spark.createDataFrame([(10**6 + i, t, None, "junk", len(t)) for i, t in enumerate(junk)], docs.schema)
    kept = language_id.keep_languages(spark, docs.unionByName(rows))
    ids = {r.doc_id for r in kept.collect()}
    assert not [i for i in range(len(junk)) if 10**6 + i in ids]
    assert {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()} == ids


def test_tables_of_a_stage_go_with_the_next(spark, scratch):
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    corpus_pipeline.run(spark, SF001).count()
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before}
    assert left <= {"llm-pipeline-decontaminate", "llm-item-windows", "llm-windows"}


def test_stages_call_the_dealt_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontaminate", "encode"]
