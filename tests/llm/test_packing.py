from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from armlens.llm import packing
from armlens.llm.common import written
from armlens.llm.queries import TOKENIZER
from tests.llm.texts import awkward, frame


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def test_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzéèêßäöüñABCÉ'.,!?0123456789|-_/\"()"
    words = ["".join(rng.choice(letters[:26] if rng.random() < 0.8 else letters) for _ in range(rng.randint(1, 12)))
             for _ in range(4_000)]
    texts = words + [" ".join(rng.sample(words, 30)) for _ in range(50)] + [
        "", "a\x1cb", "\x85 a\xa0b", "Σας ΣΑΣ", "a<|endoftext|>b", "漢字 kana", "e\u0301 x", "İstanbul", "it's he'll 'tis"]
    for text in texts:
        got = np.frombuffer(packing.token_bytes(text, TOKENIZER), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_tokenizer_of_other_rules_is_not_taken_apart(name):
    path = public_tokenizers.path(name)
    other = Tokenizer.from_file(path)
    for text in ("It's  two\n words", "UPPER lower", "  x", "e\u0301 漢", "don't 12.5%", ""):
        got = np.frombuffer(packing.token_bytes(text, path), "<u4").tolist()
        assert got == other.encode(text, add_special_tokens=False).ids
    assert packing._WORDS[path].by_word == (name == "word_bpe_49k.json")


def test_forgotten_words_are_encoded_again(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    monkeypatch.setattr(packing, "_WORDS", {})
    text = "alpha beta, gamma delta. alpha beta epsilon!"
    got = np.frombuffer(packing.token_bytes(text, TOKENIZER), "<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_first_fit_decreasing_is_the_plain_one():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(1, 101, 60)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        room, expected = [], {}
        for i in np.argsort(-sizes, kind="stable"):
            at = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
            room += [100] * (at == len(room))
            expected[i] = (at, 100 - room[at])
            room[at] -= sizes[i]
        assert [(b, o) for b, o in zip(bins, offsets)] == [expected[i] for i in range(60)]


def test_every_id_is_packed_once(spark, tokenizer):
    rows = awkward(random.Random(5))
    docs = frame(spark, rows)
    pieces = written(packing.cut_pieces(docs, TOKENIZER, length=256), "pieces")
    out = [r.asDict() for r in packing.pack(pieces, 256, group=20).collect()]
    ids = {}
    for r in sorted(out, key=lambda r: (str(r["doc_id"]), r["doc_tokens"], r["start"])):
        ids.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    want = sorted((i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows if i not in (None, 7))
    for ident, expected in want:
        parts = ids[ident, len(expected)]
        assert np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").tolist() == expected
        assert [p["start"] for p in parts] == list(range(0, len(expected), 256))
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 256
    assert sum(r["doc_tokens"] for r in out if r["start"] == 0) == sum(r["length"] for r in out)


def test_checksums_and_empty_table(spark, tokenizer):
    out = packing.pack_documents(frame(spark, [(1, "some words"), (2, None)]), TOKENIZER, with_ids=False).collect()
    for r in out:
        ids = tokenizer.encode("some words" if r["doc_id"] == 1 else "", add_special_tokens=False).ids + [2]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and r["length"] == len(ids)
    assert packing.pack_documents(frame(spark, []), TOKENIZER).collect() == []
