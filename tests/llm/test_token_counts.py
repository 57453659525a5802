"""Token counts against the library."""

import random

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from tessera.llm import token_counts
from tessera.llm import words as W
from tests.llm.data import documents, frame, odd_documents, ordered
from tests.llm.test_tokens import PIECES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def vocabulary():
    with open(PATH, "rb") as file:
        return token_counts.Vocabulary(file.read())


def fuzz(n=1500):
    rng = random.Random(8)
    pieces = [*PIECES, "▁", " ▁", "<s>", "</s>", "<unk>", "<0x0A>", " the", " of", "ing", "\xe2", "▂"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(n)] + ["", " ", "  ", "▁", "▁▁a", "a ", " a", "a  b   c", " " * 40, "▁" * 40 + "x"]


def test_counts_equal_the_library():
    own = vocabulary()
    for texts in (fuzz(), [t or "" for _, t in documents()], ["w" * 300_000, "ab" * 1000], ["", ""], []):
        data, offsets = W.utf8(pa.array(texts, pa.string()))
        assert own.counts(data, offsets).tolist() == [len(LIBRARY.encode(t)) for t in texts]


def test_whole_tokens_are_proved():
    """Each encodes alone as one token, and no other vocabulary string that begins with a blank does."""
    own = vocabulary()
    whole = {x.decode() for x in own.whole}
    assert all(len(LIBRARY.encode(x[1:])) == 1 for x in random.Random(1).sample(sorted(whole), 2000))
    pieces = [LIBRARY.id_to_piece(i) for i in range(LIBRARY.get_piece_size())]
    others = [p for p in pieces if p.startswith("▁") and len(p) > 1 and p.replace("▁", " ") not in whole]
    assert all(len(LIBRARY.encode(p[1:].replace("▁", " "))) != 1 for p in others) and len(whole) > 15_000


def test_unfit_vocabulary():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file, pytest.raises(Exception):
        token_counts.Vocabulary(file.read())


def test_query(spark):
    rows = odd_documents() + [(900 + i, t) for i, t in enumerate(fuzz(150))] + [(2000, "ab " * 4000)]
    got = token_counts.count_tokens(spark, frame(spark, rows), PATH)
    want = [(d, len((t or "").encode()), len(n := LIBRARY.encode(t or "")), len(n) > 4096) for d, t in rows]
    assert ordered(got.collect()) == ordered(want) and any(w[3] for w in want)
    assert token_counts.count_tokens(spark, frame(spark, rows).where("false"), PATH).count() == 0
