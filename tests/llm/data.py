"""Small texts with copies, near copies, nulls, ties, repeated rows and long texts."""

import random


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(seed=3, n=60):
    """Rows (doc_id, text) with distinct ids."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((i, " ".join(words(rng, rng.randrange(1, 160)))))
    base = words(rng, 120)
    for j in range(25):  # near copies of one text, each with its own changes
        copy = list(base)
        for _ in range(rng.randrange(0, 6)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(1000)}"
        rows.append((n + j, ("  " if j % 3 else "\n").join(copy).upper() if j % 2 else " ".join(copy)))
    passage = words(rng, 70)
    for j in range(12):  # texts that share a passage
        rows.append((n + 30 + j, " ".join([*words(rng, 40), *passage, *words(rng, rng.randrange(0, 60))])))
    for j in range(6):
        rows.append((n + 50 + j, "one two three"))
    rows += [(n + 60, None), (n + 61, ""), (n + 62, " \n\t "), (n + 63, "Éa éa ÀB 日本 x"), (n + 64, "y" * 5000),
             (n + 65, " ".join(words(rng, 20000))), (n + 66, "a " * 300)]
    rng.shuffle(rows)
    return rows


def odd_documents():
    """``documents`` with repeated rows, a repeated id and null ids."""
    rows = documents()
    by_id = dict(rows)
    long = next(d for d, t in rows if t and t.count(" ") > 100)
    return [*rows, (long, by_id[long]), (long, by_id[long]), (5, by_id[70]), (5, "another text under the same id"), (None, by_id[61]), (None, "alone"), (None, None)]


def frame(spark, rows, schema="doc_id long, text string"):
    """The rows with extra columns whose names clash with those that operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema).repartition(5)
    for name in ("k1", "k2", "row", "node", "kept", "component_id", "shard", "n_words", "spans", "list", "score", "letters", "payload", "part"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    return df


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])
