"""Merkle manifests against a plain tree, level by level."""

import hashlib
import random
import zlib

from tessera.llm import merkle
from tests.llm.data import frame, odd_documents, ordered

LOWER = {c: c + 32 for c in range(65, 91)}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][a : a + 16]) for a in range(0, len(out[-1]), 16)])
    return out


def path(tree, i):
    out = []
    for level in tree[:-1]:
        a = i // 16 * 16
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 16])))
        i //= 16
    return out


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text), as the query returns them."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for rs in groups.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {n: levels([leaf(r) for r in groups[n]]) for n in names}
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for i, r in enumerate(groups[n]):
            steps, cur = path(trees[n], i) + path(top, k), leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                cur = leaf((*r[:4], r[4].translate(LOWER)))
            for a, b in steps:
                cur = h(a, cur, b)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[n][-1][0], root, h(*(x for s in steps for x in s)), cur, cur == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_equals_a_plain_tree(spark):
    rng = random.Random(4)
    rows = [(d, rng.choice([None, "", "a", "a", "a", "é", "z", f"own{d}"]), rng.choice([None, "en"]), rng.choice([None, 7, -12]), t) for d, t in odd_documents()]
    docs = frame(spark, rows, SCHEMA)
    for name in ("tree", "digest", "i", "changed", "block", "f"):
        docs = docs.withColumn(name, docs.lang)
    got = merkle.prove(spark, merkle.build(spark, docs), proofs=True)
    found = got.collect()
    assert ordered(tuple(r)[:7] for r in found) == ordered(brute(rows))
    assert any(not r.verified for r in found) and any(r.verified for r in found)
    for r in found:
        assert merkle.fold(r.leaf, r.proof) == r.root
    assert merkle.manifest(spark, docs.where("false")).collect() == []


def test_a_lone_leaf(spark):
    rows = [(1, "s", None, None, None)]
    assert ordered(merkle.manifest(spark, frame(spark, rows, SCHEMA)).collect()) == ordered(brute(rows))


def test_several_tiers_and_the_whole_log(spark):
    """9000 leaves in one tree: three builders, a tier above; one of exactly 4096; nodes in completion order."""
    rows = [(i, "hot", "en", 1, f"Text {i}") for i in range(9000)] + [(i, "full", "en", 1, f"Text {i}") for i in range(4096)] + [(i, "small", None, None, "x") for i in range(17)]
    made = merkle.build(spark, spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert ordered(merkle.prove(spark, made).collect()) == ordered(brute(rows))
    log = {}
    for r in merkle.postorder(made).collect():
        log.setdefault(r.tree, []).append((r.place, r.level, r.i, r.digest.hex()))
    for name, n in (("hot", 9000), ("full", 4096), ("small", 17)):
        tree = levels([leaf(r) for r in sorted(r for r in rows if r[1] == name)])
        want, done = [], [0] * len(tree)
        for i in range(n):  # a node is appended as soon as its last leaf has come
            for k in range(len(tree)):
                if k == 0 or (i + 1) % 16**k == 0 or i + 1 == n:
                    want.append((len(want), k, done[k], tree[k][done[k]]))
                    done[k] += 1
        assert sorted(log["s" + name]) == want


def test_positions_without_a_log():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 4096, 5000):
        places = [int(merkle.position(k, i, n)) for k in range(merkle.height(n) + 1) for i in range(-(-n // 16**k))]
        assert sorted(places) == list(range(len(places)))
