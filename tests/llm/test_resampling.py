"""Importance resampling against plain Python, and CRC states against the library's."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa

from tessera.llm import resampling
from tessera.llm import words as W
from tests.llm import brute
from tests.llm.data import documents, frame, odd_documents, ordered


def features(text):
    w = brute.plain_words(text)
    return [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def expected(rows, target):
    s, t = [0] * 10000, [0] * 10000
    for _, text in rows:
        for f in features(text):
            s[bucket(f)] += 1
    for text in target:
        for f in features(text):
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1.0) * (sum(s) + 10000.0) / ((a + 1.0) * (sum(t) + 10000.0)))) for a, b in zip(s, t)]
    out = []
    for d, text in rows:
        f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r, (_, text) in zip(out, rows) if len(brute.plain_words(text)) >= 20]
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[: 25 * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r) for r in out]


def test_equals_plain_python(spark):
    rows = odd_documents() + [(3000 + i, "The the ÉA " * 30 + "x" * 300 + " " + "z" * 200) for i in range(5)]
    target = [t for _, t in documents(seed=9)] + [None, "", "one"]
    docs, items = frame(spark, rows), frame(spark, list(enumerate(target)), "item_id long, text string")
    for name in ("target", "bucket", "n", "weight", "order", "n_features"):
        docs, items = docs.withColumn(name, docs.k1), items.withColumn(name, items.k1)
    assert ordered(resampling.resample(spark, docs, items).collect()) == ordered(expected(rows, target))
    assert resampling.resample(spark, docs.where("false"), items).count() == 0
    assert ordered(resampling.resample(spark, docs, items.where("false")).collect()) == ordered(expected(rows, []))


def test_head_and_tail_give_the_same_buckets():
    rng = random.Random(6)
    words = [f"w{rng.randrange(50)}" for _ in range(400)] + ["é", "日本", "x" * 63, "x" * 64, "x" * 500]
    texts = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(40)] + [None, "", "one"]
    pairs = [f.encode() for t in texts[:10] for f in features(t) if " " in f]
    data, offsets = W.utf8(pa.array(texts))
    block = resampling.Texts(data, offsets)
    for own in (resampling.Head([], []), resampling.Head([w.encode() for w in sorted(set(words))], sorted(set(pairs))), resampling.Head([b"w1", b"w2"], [b"w1 w2", b"w9 w1"])):
        single, double = own.features(block)
        assert single.tolist() == [bucket(w) for t in texts for w in brute.plain_words(t)]
        assert double.tolist() == [bucket(f) for t in texts for f in features(t) if " " in f]


def test_joined_crc():
    rng = random.Random(5)
    parts = [(rng.randbytes(rng.randrange(30)), rng.randbytes(rng.randrange(65))) for _ in range(500)]
    got = resampling.joined_crc(*(np.array([zlib.crc32(p[k]) for p in parts], np.uint32) for k in (0, 1)), np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]
