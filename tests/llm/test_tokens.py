"""Tokenizing, token files and archives: against the library, and round trips."""

import io
import random
import time
import zipfile
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import bpe, token_files, warc
from tessera.llm import chunks as C
from tessera.llm.zip_reader import ZipRanges
from tests.llm import brute
from tests.llm.data import documents, frame, odd_documents, ordered

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PIECES = [*"abCdéàÉñßİ日本語  \n\n\t'sd're0123²Ⅷ.,!?<|>\r", "　", " ", "́", "​", "\x1c", "\x00", "\x85", "Σ", "😀", "  ",
          "<|endoftext|>", "<|startoftext|>"]


def fuzz(n=1500):
    rng = random.Random(2)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(n)] + [None, "", "   ", "a   b\n\n  c "]


@pytest.mark.parametrize("path,make", [(WORD, bpe.ForcedBoundaryBPE), (BYTE, token_files.LibraryEncoder)])
def test_encoders_equal_the_library(path, make):
    with open(path, encoding="utf-8") as file:
        codec = make(file.read())
    library, texts = Tokenizer.from_file(path), fuzz() + [t for _, t in documents()]
    data, offsets, parts = C.text_ranges(pa.array(texts))
    for lo, hi in parts:
        own = offsets[lo : hi + 1]
        ids, at = codec.encode(data[own[0] : own[-1]], own - own[0])
        for i in range(lo, hi):
            assert ids[at[i - lo] : at[i - lo + 1]].tolist() == library.encode(texts[i] or "", add_special_tokens=False).ids, repr(texts[i])


def test_forced_boundaries():
    with open(WORD, encoding="utf-8") as file:
        codec = bpe.ForcedBoundaryBPE(file.read())
    a, b = next(x + y for x in codec.symbols for y in codec.symbols if x + y not in codec.inside)
    word = "the" + a + b + "the"
    parts = codec.fragments_of(word)
    assert "".join(parts) == word and len("the" + a) in np.cumsum([len(p) for p in parts])
    inner = {t.removesuffix("</w>") for t in codec.ids}
    assert not any(a + b in t for t in inner)


def test_a_word_is_merged_once_in_all_its_surroundings():
    """Chunks that differ in blanks, case and signs share their words: few calls of the merging, for many words at a time."""
    with open(WORD, encoding="utf-8") as file:
        text = file.read()
    codec, library, rng = bpe.ForcedBoundaryBPE(text), Tokenizer.from_file(WORD), random.Random(5)
    own = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 60))) + rng.choice(["", "", "é", "ñan", "日本"]) for _ in range(300)]
    texts = [" ".join(around.format(w) for w in own) for around in ("{}", "{},", "({})", "{}\n", "{}...", "«{}»", "{0}<|endoftext|>{0}")]
    texts += [" ".join(own).upper(), " ".join(own).title()]
    merged, calls, symbols = codec.merged, [], 0

    def counted(ids, *more):
        nonlocal symbols
        calls.append(len(ids))
        symbols += len(ids)
        return merged(ids, *more)

    codec.merged = counted
    for t in texts:
        data, offsets, _ = C.text_ranges(pa.array([t]))
        assert codec.encode(data, offsets)[0].tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(calls) < 100 and symbols < 1.1 * sum(len(w.encode()) for w in own)


def test_more_words_than_are_remembered():
    """Forgotten words, words beyond the remembered size and groups of few symbols give the same ids."""
    with open(WORD, encoding="utf-8") as file:
        codec = bpe.ForcedBoundaryBPE(file.read())
    codec.known, codec.known_words = C.Remembered(5), C.Remembered(5)
    library, rng = Tokenizer.from_file(WORD), random.Random(6)
    own = ["".join(rng.choice("theaninor") for _ in range(rng.choice([1, 2, 3, 47, 48, 49, 63, 64, 65, 200]))) for _ in range(120)]
    for _ in range(20):
        t = " ".join(rng.choice(own) + rng.choice(["", "!", "é", "'s", "7"]) for _ in range(60))
        data, offsets, _ = C.text_ranges(pa.array([t]))
        assert codec.encode(data, offsets)[0].tolist() == library.encode(t, add_special_tokens=False).ids


def long_words():
    """Runs of letters without a blank: one letter, a few, all kinds, up to a million."""
    rng = random.Random(7)
    return ["a" * 1_000_000, "".join(rng.choice("ab") for _ in range(200_000)), "".join(rng.choice("etaoinshrdlu") for _ in range(200_000)), "ha" * 50_000,
            "x".join("é日本" for _ in range(20_000)), "".join(rng.choice("abcdefgh") for _ in range(49)), "abc" * 17]


def test_long_words_take_seconds():
    """A word of a million letters is merged as the library merges it, in time that doesn't grow with its square."""
    with open(WORD, encoding="utf-8") as file:
        codec = bpe.ForcedBoundaryBPE(file.read())
    library, began = Tokenizer.from_file(WORD), time.time()
    for text in long_words():
        data, offsets, _ = C.text_ranges(pa.array([text]))
        assert codec.encode(data, offsets)[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert time.time() - began < 90


def test_long_words_in_documents(spark):
    rows = list(enumerate(long_words()[:3]))
    library = Tokenizer.from_file(WORD)
    assert ordered(bpe.digests(bpe.encode(spark, frame(spark, rows), WORD, decoded=True)).collect()) == ordered(brute.round_trip(rows, library))
    library = Tokenizer.from_file(BYTE)
    assert ordered(tuple(r)[:4] for r in token_files.round_trip(spark, frame(spark, rows), BYTE).collect()) == ordered(brute.token_files(rows, library))


def test_bpe_round_trip(spark):
    rows = odd_documents() + [(900 + i, t) for i, t in enumerate(fuzz(150))]
    encoded = bpe.encode(spark, frame(spark, rows), WORD, decoded=True)
    library = Tokenizer.from_file(WORD)
    assert ordered(bpe.digests(encoded).collect()) == ordered(brute.round_trip(rows, library))
    again = bpe.decode(spark, bpe.encode(spark, frame(spark, rows), WORD), WORD)
    assert ordered(r[0] for r in [(x.decoded,) for x in again.collect()]) == ordered(r[0] for r in [(x.decoded,) for x in encoded.collect()])
    assert bpe.digests(bpe.encode(spark, frame(spark, rows).where("false"), WORD, decoded=True)).count() == 0


def test_token_files(spark):
    rows = documents() + [(None, "no id"), (900, "again and again")]
    library = Tokenizer.from_file(BYTE)
    got = token_files.round_trip(spark, frame(spark, rows), BYTE)
    assert ordered(tuple(r)[:4] for r in got.collect()) == ordered(brute.token_files(rows, library))
    assert token_files.round_trip(spark, frame(spark, rows).where("false"), BYTE).count() == 0


def test_repeated_ids_keep_a_fixed_order(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (0, "d e f"), (2, None)]
    twice = [ordered(tuple(r)[:4] for r in token_files.round_trip(spark, frame(spark, rows), BYTE).collect()) for _ in range(2)]
    assert twice[0] == twice[1] and [r[0] for r in sorted(twice[0], key=lambda r: r[1])] == [0, 1, 1, 1, 2]


def test_documents_that_span_batches_and_files_of_one_id(spark):
    """Checksums go on over batches of sequences; an id with many texts is written by several tasks."""
    rows = [(5, f"text {i} of one id " * (1 + i % 40)) for i in range(400)] + [(6, "a long text " * 150_000), (7, None)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else these few rows would be one task's
    try:
        folder, manifest = token_files.save(spark, frame(spark, rows), BYTE, length=16)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = token_files.load(spark, folder, manifest)
    library = Tokenizer.from_file(BYTE)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got.collect()) == sorted((d, n, c) for d, _, n, c in brute.token_files(rows, library))
    starts = [(r.start, r.n_tokens) for r in got.orderBy("start").collect()]
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert got.where("doc_id = 5").select("file").distinct().count() > 1


def test_joined_chunks_equal_chunks_alone():
    with open(BYTE, encoding="utf-8") as file:
        codec = token_files.LibraryEncoder(file.read())
    chunks = [c.encode() for c in [*(t for t in fuzz(800) if t), " the", " a", "x", "\n\ny", " <|endoftext|>", "<|endoftext|>", " é", "　", " z "]]
    codec.JOINED_BYTES = 64
    assert codec._ids(chunks) == [x.astype("<u4").tobytes() for x in codec._alone(chunks)]


def test_sequences_are_read_in_place(spark):
    rows = [(i, t) for i, t in documents() if t]
    folder, manifest = token_files.save(spark, frame(spark, rows), BYTE, length=64)
    library, total = Tokenizer.from_file(BYTE), 0
    for m in manifest.orderBy("part").collect():
        file = token_files.SequenceFile(folder, m.file)
        ids = np.concatenate([x for x, _ in file.tokens()])
        total += len(ids)
        for i in (0, len(ids) // 64 // 2, len(ids) // 64):
            got, mask = file.sequence(i) if i * 64 < len(ids) else (np.zeros(0, np.uint16), np.zeros(0, bool))
            assert (got[mask] == ids[i * 64 : i * 64 + 64]).all() and not got.flags.owndata
        file.close()
    assert total == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)


PAGES = [(1, "http://a", "<p>x"), (2, None, "<p>x"), (3, "u\r\nX: y é", None), (4, "", ""), (None, "n", "<p>x"), (None, "n", "solo"), (9, "z", "é" * 5000),
         (7, "z", "é" * 5000), (7, "z", "é" * 5000), (11, "q", "a\r\n\r\nb"), (12, "q", "long " * 200_000), (None, None, "two"), (None, None, "two")]


def test_warc(spark):
    pages = frame(spark, PAGES, "page_id long, url string, html string")
    folder, manifest = warc.save(spark, pages)
    got = warc.load(spark, folder, manifest, payloads=True).collect()
    assert ordered((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == ordered(brute.warc(PAGES))
    stored = {(r.page_id, bytes(r.payload)) for r in got if r.record_type == "response"}
    assert stored == {(p, (h or "").encode()) for p, _, h in PAGES if (p, "response") in {(r.page_id, r.record_type) for r in got}} - {(None, b"<p>x")}
    assert warc.round_trip(spark, pages.where("false")).count() == 0


def test_zip_ranges():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.comment = b"PK\x05\x06 in a comment"
        z.writestr("a.txt", b"0123456789")
        z.writestr("é.txt", b"x" * 1000, zipfile.ZIP_DEFLATED)
        with z.open("big", "w", force_zip64=True) as m:
            m.write(b"abc" * 100)
    archive = ZipRanges(raw, len(raw.getvalue()))
    assert set(archive.members) == {"a.txt", "é.txt", "big"} and archive.read("a.txt", 3, 4) == b"3456" and archive.read("big", 297, 3) == b"abc"
    for bad in (lambda: archive.read("é.txt", 0, 5), lambda: archive.read("a.txt", 8, 5), lambda: ZipRanges(io.BytesIO(b"no"), 2)):
        with pytest.raises(ValueError):
            bad()


def test_zip64_directory():
    """More members than 16 bits count: the directory is found through its ZIP64 records."""
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for i in range(65_600):
            z.writestr(str(i), b"%d" % i)
    archive = ZipRanges(raw, len(raw.getvalue()))
    assert len(archive.members) == 65_600 and archive.read("65599", 0, 5) == b"65599"


def test_blocks_bound_what_is_encoded_at_a_time():
    """Small blocks give the same ids and texts, in batches of no more text than a block or one row."""
    texts = ["the quick brown fox " * (i % 40) for i in range(300)] + [None, "", "x" * 3000]
    keys = pa.array([0] * len(texts), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), keys, keys, pa.array(texts)], ["doc_id", "k1", "k2", "text"])
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        sent = SimpleNamespace(value=file.read())
    whole, small = (list(bpe._round_trip(iter([batch]), sent, True, **more)) for more in ({}, {"block_bytes": 1000}))
    assert len(whole) == 1 and pa.Table.from_batches(small).combine_chunks() == pa.Table.from_batches(whole).combine_chunks()
    size = dict(enumerate(len(t or "") for t in texts))
    assert all(b.num_rows == 1 or sum(size[d] for d in b["doc_id"].to_pylist()) <= 1000 for b in small)
    assert corpus_pipeline.BLOCK_BYTES < bpe.BLOCK_BYTES
