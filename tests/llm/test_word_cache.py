"""The encoder's bounded memory of units and words."""

import public_tokenizers
import numpy as np
from tokenizers import Tokenizer

from epigrid.llm import word_bpe
from epigrid.llm.word_bpe import WordBpe

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_frequent_units_outlive_a_full_memory(monkeypatch):
    """Units that come back in every batch are learned once, however often the memory of rare ones is dropped."""
    bpe, learned = WordBpe(WORDS, remember=50), []
    keep = bpe._learn
    monkeypatch.setattr(bpe, "_learn", lambda new: (learned.extend(new), keep(new)))
    for k in range(20):
        bpe.encode([" ".join(["often", "Seen,", "ünder", "x9-y"] + [f"rare{k}n{j}" for j in range(60)])])
        assert len(bpe.units) + len(bpe.old_units) < 300 and len(bpe.words) + len(bpe.old_words) < 300
    assert [learned.count(u) for u in ("often", "Seen,", "ünder", "x9-y")] == [1, 1, 1, 1]


def test_small_portions_and_memory_change_no_id(monkeypatch):
    monkeypatch.setattr(word_bpe, "AT_ONCE", 3)
    texts = ["Don't stop, STOP. a1b2 x9-y", "", None, "Größe ŸÇ İstanbul ıx ß. ſ, ..", "tab\there \x00 ctl\x7f end!", "日本 語, ok?", "É, é; É.. A", "don't", "stop, Größe"]
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    wanted = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    bpe = WordBpe(WORDS, remember=4)
    for _ in range(3):
        found = [np.frombuffer(bpe.encode([t])[0], "<u4").tolist() for t in texts]
        assert found == wanted
