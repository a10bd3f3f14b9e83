"""op1's ids where a text holds the strings of added tokens: those of the library in its default state."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from epigrid.llm.queries import op1_best_fit_packing
from epigrid.llm.word_bpe import WordBpe
from llm.conftest import frame

WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["a <|endoftext|> b", "a<|startoftext|>b\nc <|ENDOFTEXT|>", "<|endoftext|><|endoftext|>", "no token", "<|endoftext|", None, ""]


def test_added_tokens(spark, tmp_path):
    library = Tokenizer.from_file(WORDS)
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert wanted[0] == [320, 49407, 321]
    assert [np.frombuffer(d, "<u4").tolist() for d in WordBpe(WORDS, added_tokens=True).encode(TEXTS)] == wanted
    frame(spark, list(enumerate(TEXTS))).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in op1_best_fit_packing(spark, str(tmp_path)).collect()}
    assert found == {k: (len(i) + 1, zlib.crc32(np.array([*i, 0], "<u4").tobytes())) for k, i in enumerate(wanted)}
