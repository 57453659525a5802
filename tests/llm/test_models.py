"""Language identification, nearest neighbours, sharding, toxicity and the pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, language_id, sharding, toxicity
from tests.conftest import SF01
from tests.llm import brute
from tests.llm.data import frame, odd_documents, ordered


def crc(d):
    return zlib.crc32(str(d).encode()) % 4


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = language_id.identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id) == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_language_id_learns_from_no_held_out_document(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    spoilt = docs.withColumn("lang", F.when(language_id.held_out("doc_id"), "xx").otherwise(F.col("lang")))
    a, b = (ordered(language_id.identify(spark, x).collect()) for x in (docs, spoilt))
    assert a == b


def test_code_lengths_are_exact():
    """The model's code length of a text equals one counted byte by byte from the contexts."""
    import pyarrow as pa

    from tessera.llm import words as W

    train, text = [b"abracadabra", b"banana band"], b"abanzab"
    grams = np.concatenate([language_id._grams(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 2) for t in train])
    model = language_id.Model(["x"], np.zeros(len(grams), int), grams, np.ones(len(grams)), 2)
    data, offsets = W.utf8(pa.array([text.decode()]))
    got = model.bits(data, offsets)[0, 0]
    padded, seen = [b"\0\0" + t for t in train], {}
    for t in padded:
        for i in range(2, len(t)):
            for o in range(3):
                seen.setdefault(t[i - o : i], {}).setdefault(t[i], 0)
                seen[t[i - o : i]][t[i]] += 1
    want, t = 0.0, b"\0\0" + text
    for i in range(2, len(t)):
        for o in (2, 1, 0, -1):
            counts = seen.get(t[i - o : i]) if o >= 0 else None
            if o < 0:
                want += 8
            elif counts is not None:
                whole = sum(counts.values()) + len(counts)
                if t[i] in counts:
                    want -= np.log2(counts[t[i]] / whole)
                    break
                want -= np.log2(len(counts) / whole)
    assert abs(got - want) < 1e-9


def test_language_id_of_odd_rows(spark):
    rows = [(i, "the cat sat on the mat" if i % 2 else "die katze saß auf der matte", "en" if i % 2 else "de") for i in range(40)]
    rows += [(50, None, "en"), (51, "", "en"), (52, "123 !?", "en"), (53, "the mat", None), (None, "the cat", "en"), (1, rows[1][1], "en"), (54, "x" * 300_000, None)]
    got = language_id.identify(spark, frame(spark, rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (50, 51, 52)] == ["und"] * 3 and [by[i].score for i in (50, 51, 52)] == [0.0] * 3
    assert by[53].lang_pred == "en" and by[None].lang_pred == "en" and by[None].held_out
    none = language_id.identify(spark, frame(spark, [(1, "abc", None)], "doc_id long, text string, lang string")).collect()
    assert none[0].lang_pred == "und"
    assert language_id.identify(spark, frame(spark, rows, "doc_id long, text string, lang string").where("false")).count() == 0


def ppm(texts, order=language_id.ORDER):
    """Bits of a text under contexts counted byte by byte from ``texts`` (plain ASCII)."""
    seen = {}
    for t in texts:
        t = b"\0" * order + t.lower().encode()
        for i in range(order, len(t)):
            for o in range(order + 1):
                after = seen.setdefault(t[i - o : i], {})
                after[t[i]] = after.get(t[i], 0) + 1

    def bits(text):
        out, t = 0.0, b"\0" * order + text.lower().encode()
        for i in range(order, len(t)):
            for o in range(order, -2, -1):
                after = seen.get(t[i - o : i]) if o >= 0 else None
                if o < 0:
                    out += 8
                elif after:
                    whole = sum(after.values()) + len(after)
                    out -= np.log2(after.get(t[i], len(after)) / whole)
                    if t[i] in after:
                        break
        return out

    return bits


@pytest.mark.parametrize("languages", [2, 200])
def test_prediction_and_score_byte_by_byte(spark, languages):
    """Every language is learned, however many at a time; predictions and scores equal those from plain contexts."""
    rng = np.random.default_rng(3)
    names = [f"l{k}" for k in range(7)]
    sounds = {x: ["".join(rng.choice(list("abcdefghijklmnop"), 3)) for _ in range(12)] for x in names}
    rows = [(i, " ".join(rng.choice(sounds[names[i % 7]], rng.integers(1, 12))), names[i % 7] if i % 3 else None) for i in range(150)]
    got = language_id.identify(spark, frame(spark, rows, "doc_id long, text string, lang string"), languages=languages).collect()
    models = {x: ppm([t for d, t, lang in rows if lang == x and crc(d) != 2]) for x in names}
    for r in got:
        bits = {x: models[x](dict((d, t) for d, t, _ in rows)[r.doc_id]) for x in names}
        best = min(sorted(bits), key=bits.get)
        assert r.lang_pred == best and abs(r.score - 1 / sum(2.0 ** (bits[best] - b) for b in bits.values())) < 1e-9
        assert abs(r.bits_per_byte - bits[best] / len(rows[r.doc_id][1])) < 1e-9


def test_a_repeated_labelled_id_stays_within_the_sample(spark):
    rows = [(3, f"the cat {i} sat on mat {i * 7}", "en") for i in range(400)] + [(i, f"die katze {i} sitzt", "de") for i in range(100, 140)]
    sample = language_id._Sample(frame(spark, rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang", 20)
    assert {r["lang"]: r["count"] for r in sample.texts(sample.languages).groupBy("lang").count().collect()} == {"en": 20, "de": 20}


def test_languages_kept_in_parts(spark):
    """The same texts stay when languages are judged one at a time."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(300).unionByName(spark.createDataFrame([(10**6, "qzxv" * 100, None, None, 400)], "doc_id long, text string, lang string, source string, n_chars long"))
    docs = docs.cache()
    one, all_ = ({r.doc_id for r in language_id.keep_languages(spark, docs, languages=n).collect()} for n in (1, 200))
    docs.unpersist()
    assert one == all_ and 10**6 not in one and len(one) > 250


def test_languages_are_learned_from_all_labelled_texts(spark, monkeypatch):
    """Models and bounds take every labelled text that isn't held out, in parts by grams too; bounds are counted, not estimated."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(["the", "ing", "and", "ough", "str", "ee"], rng.integers(60, 90))), ("en", "xx", None)[(i % 7 > 4) + (i % 9 > 7)]) for i in range(2600)]
    rows += [(None, "held " * 60, "en"), (6, None, "en"), rows[1], rows[1]]
    docs = frame(spark, rows, "doc_id long, text string, lang string").cache()
    learned, start = language_id._learned_bounds, language_id.Model.__init__
    texts, counts, bounds = [], [], []

    def learn(scores):
        found = [(r.lang_pred, r.least / r.n_bytes) for r in scores.collect()]
        texts.append(len(found))
        bounds.append((found, {r.lang_pred: r.bound for r in learned(scores)}))
        return learned(scores)

    def begin(self, languages, language, grams, n, order):
        counts.append(int(n.sum()))
        start(self, languages, language, grams, n, order)

    monkeypatch.setattr(language_id, "_learned_bounds", learn)
    monkeypatch.setattr(language_id.Model, "__init__", begin)
    own = [t for d, t, lang in rows if lang and t and d is not None and crc(d) != 2]
    kept = [sorted(r.doc_id for r in language_id.keep_languages(spark, docs, **more).where("doc_id IS NOT NULL").collect()) for more in ({}, {"cells": 1})]
    docs.unpersist()
    assert len(own) > 1500 and texts == [len(own)] * 2
    assert counts[0] == sum(counts[1:]) == sum(len(t.encode()) for t in own) and len(counts) == 3
    assert kept[0] == kept[1] and bounds[0][1] == bounds[1][1]
    for lang, bound in bounds[0][1].items():
        rates = sorted(x for name, x in bounds[0][0] if name == lang)
        assert bound == np.ceil(rates[int(np.ceil(0.999 * len(rates))) - 1] * 1024) / 1024


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    p = sharding.FeistelPermutation(n)
    there = p.forward(np.arange(n))
    assert sorted(there.tolist()) == list(range(n)) and (p.backward(there) == np.arange(n)).all()


def test_sharding(spark):
    rows = odd_documents()
    got = sharding.shard(spark, frame(spark, rows)).collect()
    assert ordered((r.doc_id, r.size, r.text_crc32) for r in got) == ordered((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(v) for v in by.values()]
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and max(sizes) - min(sizes) <= 1 and set(by) == set(range(16))
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    for r in got:
        assert [int(x[0]) for x in sharding.locate([r.row], len(rows))] == [r.shard, r.slot]
        assert int(sharding.row_at(r.shard, r.slot, len(rows))) == r.row
    assert ordered(sharding.shard(spark, frame(spark, rows)).collect()) == ordered(got)  # another dealing of the rows, the same shards
    assert sharding.shard(spark, frame(spark, rows).where("false")).count() == 0


def test_nearest_neighbours_recall(spark):
    for sf in ("sf0.01", "sf0.1"):
        df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        want = brute.nearest([(r.vec_id, r.embedding) for r in df.collect()])
        got = {}
        for r in ann.search(spark, df).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
        hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
        assert hits >= 0.9 * 10 * len(want)
        exact = {q: dict(brute_all(df, q)) for q in list(want)[:2]} if sf == "sf0.01" else {}
        for q, distances in exact.items():
            assert all(abs(distances[v] - s) < 1e-9 for v, s in got[q])


def brute_all(df, q):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in df.collect()]
    x = dict(rows)[q]
    return [(i, float(np.sqrt(((v - x) ** 2).sum()))) for i, v in rows]


def test_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    same = [1.0] * 8
    rows += [(100, same), (101, same), (102, same), (103, same), (200, None), (300, [0.0] * 8), (400, [None] + [1.0] * 7), (500, [float("nan")] * 8),
             (600, [float("inf")] * 8), (700, [1.0, 2.0]), (None, same), (800, [])]
    part = [(i, v) for i, v in rows if i is not None and i < 200]
    got = {}
    for r in ann.search(spark, frame(spark, rows, "vec_id long, embedding array<double>"), share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute.nearest(part)
    assert {q: [a for a, _ in v] for q, v in got.items()} == {q: [a for a, _ in v] for q, v in want.items()}
    few = frame(spark, rows[:3] + [(100, same)], "vec_id long, embedding array<double>")
    assert ann.search(spark, few).count() == 3 + 3  # queries 0 and 100, all candidates
    assert ann.search(spark, few.where("false")).count() == 0


def test_abandoned_candidates_are_far():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = ann.Index(x, 10)
    found = 0
    for q in range(20):
        rows, distance = ann.nearest_in_block(x[q], x[q] @ index.rotation, x, x @ index.rotation, np.arange(3000), 10)
        best = np.argsort(((x - x[q]) ** 2).sum(axis=1), kind="stable")[:10]
        found += len(set(rows.tolist()) & set(best.tolist()))
        assert (np.diff(distance) >= 0).all()
    assert found >= 196


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where(~language_id.held_out("doc_id"))
    got = toxicity.classify(spark, docs, known).join(labels.where(language_id.held_out("doc_id")).withColumnRenamed("toxic", "y"), "doc_id").collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    toxic, clean = [r for r in got if r.y == 1], [r for r in got if r.y == 0]
    assert {lang[r.doc_id] for r in toxic} == {"en", "de", "fr", "es"}
    for name in ("en", "de", "fr", "es"):
        own = [r for r in toxic if lang[r.doc_id] == name]
        assert sum(r.toxic for r in own) >= 0.8 * len(own), name
    assert sum(r.toxic for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r.p_toxic <= 1 and 0 <= r.p_low_quality <= 1 for r in got)


def test_toxicity_features_leave_room_for_every_group(spark):
    """The signs of a large group would fill any budget; those of two small groups count too, one of them a word that is merely frequent."""
    rng = np.random.default_rng(8)

    def text(alphabet, n=60):
        return ["".join(rng.choice(list(alphabet), 5)) for _ in range(n)]

    signs, rows = ["".join(rng.choice(list("abcdef"), 8)) for _ in range(150)], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append(("large", toxic, " ".join(text("abcdef") + signs * toxic)))
    for i in range(120):
        toxic = i % 4 == 0
        rows.append(("word", toxic, " ".join(text("ghijkl") + ["hgkjilhhgg", "klklggjjih"] * toxic)))
        rows.append(("rate", toxic, " ".join(rng.permutation(text("mnopqr") + ["onrqmp"] * (8 if toxic else 1)))))
    docs = frame(spark, [(i, t) for i, (_, _, t) in enumerate(rows)])
    labels = frame(spark, [(i, 1, int(toxic)) for i, (_, toxic, _) in enumerate(rows) if i % 5], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.toxic for r in toxicity.classify(spark, docs, labels).collect()}
    for group in ("large", "word", "rate"):
        new = [(got[i], toxic) for i, (g, toxic, _) in enumerate(rows) if g == group and not i % 5]
        assert sum(y for _, y in new) >= 3 and sum(a == b for a, b in new) >= 0.95 * len(new), group


def test_known_features_are_those_of_the_whole_text():
    import pyarrow as pa

    from tessera.llm import words as W

    rng = np.random.default_rng(9)
    data, offsets = W.utf8(pa.array(["".join(rng.choice(list("ab c"), n)) for n in (0, 3, 400, 5000, 1)] + [None, "ab" * 300]))
    row, feature = toxicity._features(data, offsets, None)
    some = np.unique(feature)[::3]
    got = set(zip(*(x.tolist() for x in toxicity._features(data, offsets, toxicity._lookup(some))), strict=True))
    assert got == {(r, int(np.searchsorted(some, f))) for r, f in zip(row.tolist(), feature, strict=True) if f in some}
    assert (feature >> np.uint64(40)).max() == len(toxicity.RATES)


def test_chain_uses_held_out_predictions():
    """The second category is decided by the first: its model learns that from probabilities that aren't fitted to the row itself."""
    rng = np.random.default_rng(6)
    n, m = 400, 30
    present = rng.random((n, m)) < 0.3
    row, feature = np.nonzero(present)
    first = present[:, 0].astype(float)
    noise = rng.random(n) < 0.02
    labels = np.column_stack([first, np.where(noise, 1 - first, first)])
    labels[:20, 1] = np.nan
    held_out = np.column_stack([toxicity.out_of_fold(row, feature, np.zeros((n, 0)), first, m), np.zeros(n)])
    models = toxicity.fit_chain(row, feature, labels, m, np.ones((2, m), bool), held_out)
    assert len(models[0].chain) == 0 and len(models[1].chain) == 1 and models[1].chain[0] > 0.5


def indexed(spark, texts):
    """The table of grams that ``choose`` reads, as ``train`` makes it."""
    rows = spark.createDataFrame(list(enumerate(texts)), "number int, text string").repartition(3)
    index = rows.mapInArrow(toxicity._texts_of, "feature long, texts binary").groupBy("feature").agg(F.collect_list("texts").alias("parts"))
    return index.mapInArrow(toxicity._together, "feature long, texts binary").cache()


def auc(y, p):
    order = np.argsort(p, kind="stable")
    ranks = np.empty(len(p))
    ranks[order] = np.arange(len(p))
    return (ranks[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


def test_held_out_predictions_of_noise_know_nothing(spark):
    """Labels drawn at random: features chosen with a text's own label would tell it, those of the other folds can't."""
    rng = np.random.default_rng(4)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(60)) for _ in range(600)]
    labels = rng.integers(0, 2, (600, 2)).astype(float)
    index = indexed(spark, texts)
    _, _, keys, own, held_out = toxicity.choose(spark, index, labels, 300)
    assert own.shape == (2, len(keys)) and own.any(axis=0).all()
    assert all(0.42 <= auc(labels[:, i], held_out[:, i]) <= 0.58 for i in (0, 1))
    index.unpersist()


def test_first_features_and_chain_by_brute_force(spark, monkeypatch):
    """One step of choosing equals gains counted text by text; the held-out column is that of the views without the fold."""
    monkeypatch.setattr(toxicity, "STEPS", 1)
    rng = np.random.default_rng(2)
    y = (np.arange(90) % 3 == 0).astype(float)
    texts = [" ".join([*("".join(rng.choice(list("abcd"), 3)) for _ in range(12)), *["xyzzy"] * int(t)]) for t in y]
    index, seen, honest = indexed(spark, texts), [], toxicity._honest
    monkeypatch.setattr(toxicity, "_honest", lambda picks, *rest: (seen.append(picks), honest(picks, *rest))[1])
    row, feature, keys, own, held_out = toxicity.choose(spark, index, y[:, None], 15)
    index.unpersist()
    has = {}
    for i, t in enumerate(texts):
        raw = b"\0" * 4 + t.encode()
        grams = [int.from_bytes(raw[j - 4 : j + 1], "big") for j in range(4, len(raw))]
        for g in set(grams):
            has.setdefault(g, set()).add(i)
            for k, rate in enumerate(toxicity.RATES, 1):
                if grams.count(g) >= 2 and grams.count(g) * rate >= len(t):
                    has.setdefault(g | k << 40, set()).add(i)

    def gains(view):
        known = np.isfinite(view)
        p = view[known].mean()
        return {f: round(abs(sum(view[i] - p for i in rows if known[i])) / np.sqrt(p * (1 - p) * sum(known[i] for i in rows) + 1), 9)
                for f, rows in has.items() if sum(known[i] for i in rows) >= toxicity.SUPPORT}

    fold = np.arange(90) % toxicity.FOLDS
    for f, pick in enumerate(seen[-1]):
        view = np.where(fold == f, np.nan, y)
        gain = gains(view)
        assert sorted(gain[g] for g in pick.chosen.tolist()) == sorted(gain.values())[-15:]  # the labels of the fold have no say
        r, c = np.array([(i, k) for k, g in enumerate(pick.chosen.tolist()) for i in sorted(has[g])]).T
        assert sorted(zip(r, c)) == sorted(zip(pick.row, pick.feature))
        if f < toxicity.FOLDS:
            model = toxicity.fit(*toxicity._known(np.isfinite(view), r, c, np.zeros((90, 0)), view), 15)
            assert np.allclose(model.probability(r, c, np.zeros((90, 0)))[fold == f], held_out[fold == f, 0])
    assert set(zip(row.tolist(), keys[feature].tolist())) == {(i, g) for g in keys.tolist() for i in has[g]} and sorted(keys.tolist()) == sorted(seen[-1][-1].chosen.tolist())


def test_a_repeated_labelled_id_brings_no_more_rows_than_the_sample(spark):
    docs = frame(spark, [(1, f"text number {i} of one id") for i in range(400)] + [(i, f"idiot {i}" if i % 2 else f"fine day {i}") for i in range(2, 60)])
    labels = frame(spark, [(i, 1, i % 2) for i in range(1, 60)], "doc_id long, quality int, toxic int")
    seen = []
    real = toxicity.choose
    try:
        toxicity.choose = lambda spark, index, y, features: (seen.append(len(y)), real(spark, index, y, features))[1]
        assert toxicity.classify(spark, docs, labels, sample=50).count() == 458
    finally:
        toxicity.choose = real
    assert seen == [50]


def test_toxicity_of_odd_rows(spark):
    rows = [(i, f"you idiot moron {i}" if i % 3 == 0 else f"a good day to you {i}") for i in range(90)]
    rows += [(200, None), (201, ""), (202, "you idiot moron " * 3000), (None, "you idiot moron"), (0, rows[0][1])]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(90)] + [(999, 0, 1), (None, 1, 1), (3, None, None), (200, 1, 0), (1, 1, 0), (1, 1, 0)]
    frames = frame(spark, rows), frame(spark, labels, "doc_id long, quality int, toxic int")
    got = toxicity.classify(spark, *frames).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[0].toxic and not by[1].toxic and by[202].toxic and by[None].toxic
    assert by[200].p_toxic == by[201].p_toxic == 0.0
    unlabelled = toxicity.classify(spark, frames[0], frames[1].where("false")).collect()
    assert len(unlabelled) == len(rows) and not any(r.toxic for r in unlabelled)
    assert toxicity.classify(spark, frames[0].where("false"), frames[1]).count() == 0
