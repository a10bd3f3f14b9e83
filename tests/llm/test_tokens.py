"""Packing (1) and SentencePiece (7): against the libraries, and round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import rows
from epigrid.llm import packing, sentencepiece_codec
from epigrid.llm.bpe import LONG, Merges
from epigrid.llm.word_bpe import WordBpe
from llm.conftest import frame

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def odd_texts(letters, n=600):
    rng = random.Random(11)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)] + ["ab" * 3000, "é" * 700 + " x"]


def library():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def test_pieces_match_the_library():
    ours, theirs = sentencepiece_codec.Codec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in odd_texts("ab the  \n\ting▁é😀0x<s>\0"):
        ids = theirs.encode(text)
        assert ours.encode(text) == ids
        assert ours.decode(ids) == theirs.decode(ids)


def test_word_ids_match_the_library():
    ours, theirs = WordBpe(WORDS), library()
    for text in odd_texts("abTHE't  's12\n\tingé́😀<|>!.½²ĲįİΣς\x85\xa0\x1c"):
        assert np.frombuffer(ours.encode([text])[0], "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_long_words_merge_as_short_ones_do():
    """Heap and rounds give the same order, also where a merge makes a better pair."""
    merges = Merges([0, 2, 1], [1, 0, 0], [2, 3, 4], [5, 1, 3])
    rng = np.random.default_rng(3)
    for _ in range(50):
        word = rng.integers(0, 2, rng.integers(1, LONG))
        symbols, counts = merges.run(word, np.array([len(word)]))
        assert symbols.tolist() == merges._heap(word).tolist() and counts.tolist() == [len(symbols)]


def test_sentencepiece_rows(spark, edge_rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    wanted = [
        (i, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids) if ids else ""))
        for i, t in edge_rows
        for ids in [sp.encode(t or "")]
    ]
    found = sentencepiece_codec.digests(frame(spark, edge_rows), PIECES)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
    assert sentencepiece_codec.digests(frame(spark, []), PIECES).count() == 0
    ids = {r["doc_id"]: r["ids"] for r in sentencepiece_codec.encode(frame(spark, [(1, "a b"), (2, None)]), PIECES).collect()}
    assert ids == {1: sp.encode("a b"), 2: []}


def fewest(lengths, capacity):
    """Best fit, longest first."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps.remove(fit)
            gaps.append(fit - n)
    return len(gaps)


@pytest.mark.parametrize("length", [64, 2048])
def test_packing(spark, edge_rows, length):
    t = library()
    docs = frame(spark, edge_rows)
    found = packing.pack(docs, WORDS, length).collect()
    wanted = []
    for i, text in edge_rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), length)):
            part = ids[at : at + length]
            wanted.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r[:5] for r in found), key=repr) == sorted(wanted, key=repr)
    held = {}
    for r in found:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
        assert sum(n for _, n in parts) <= length
    assert len(held) <= fewest([w[3] for w in wanted], length) + 1


def test_packed_sequences_hold_the_ids(spark, edge_rows):
    docs = frame(spark, edge_rows)
    placed = packing.pack(docs, WORDS, 256)
    found = {r["sequence_id"]: r for r in packing.sequences(docs, placed, WORDS, 256).collect()}
    for r in placed.collect():
        ids = found[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]


def test_packing_in_many_shards(spark):
    rng = random.Random(4)
    docs = frame(spark, [(i, "a " * rng.randint(0, 300)) for i in range(400)])
    found = packing.pack(docs, WORDS, 512, per_shard=50).collect()
    assert len(found) == 400 and len({r["sequence_id"] for r in found}) <= fewest([r["length"] for r in found], 512) + 8
    assert packing.pack(frame(spark, []), WORDS).count() == 0
    assert rows(packing.pack(frame(spark, [(1, None)]), WORDS), "doc_id", "length", "offset") == [(1, 1, 0)]


def test_sum_of_squares_rule():
    """Of the gaps that fit, the one that makes the sum of squared counts smallest is taken."""
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 40, 300)
    sequence, offset = packing.places(lengths, 40)
    room = {}
    for size, s, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        gaps = [40 - used for used in room.values()]
        count = {g: gaps.count(g) for g in set(gaps)}

        def after(g):
            c = dict(count)
            c[g] -= 1
            c[g - size] = c.get(g - size, 0) + 1
            return sum(n * n for gap, n in c.items() if gap)

        fits = [g for g in count if g >= size]
        assert o == room.get(s, 0)
        if fits:
            assert after(40 - o) == min(map(after, fits))
        else:
            assert o == 0
        room[s] = o + size
