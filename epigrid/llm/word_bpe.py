"""Ids of a word-level BPE tokenizer file, as the `tokenizers` library gives them, with every different word merged once.

A text is cut at spaces and line feeds, which such a tokenizer drops. Units of Latin letters, digits and signs are put in
lower case and cut by the file's own pattern here; units with any other character go through the library. Strings of
added (special) tokens count as ordinary text, or with `added_tokens` a text that holds one goes through the library whole, which
gives the tokens' own ids.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

from epigrid.llm.bpe import Merges

CACHED = 300_000
#: Words merged at once: their symbols stay in a core's cache.
AT_ONCE = 8_000
#: Characters that the normaliser only puts in lower case.
SIGNS = ".,!?;:"
PLAIN = regex.compile(r"[!-~¡-¬®-įıĲ-ɏ]*")


class WordBpe:
    def __init__(self, path: str, added_tokens: bool = False, remember: int = CACHED):
        self.remember = remember
        self.default = Tokenizer.from_file(path)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if added_tokens and any(t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("only added tokens that stand in the text as they are, are supported")
        self.added = [t["content"] for t in spec["added_tokens"]] if added_tokens else []
        steps = spec["normalizer"]["normalizers"] if spec["normalizer"] else []
        split, spelled = spec["pre_tokenizer"]["pretokenizers"]
        model = spec["model"]
        if (
            [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE"
            or split["type"] != "Split" or not split["invert"] or split["behavior"] != "Removed"
            or spelled["type"] != "ByteLevel" or spelled["add_prefix_space"] or spelled["use_regex"]
            or not model["end_of_word_suffix"] or model["ignore_merges"] or model["dropout"]
        ):
            raise ValueError("only lower-case word BPE files are supported")
        self.cut = regex.compile(split["pattern"]["Regex"]).findall
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letter = _byte_letters()
        self.inner = np.array([vocab[c] for c in letter], np.int64)
        self.last = np.array([vocab[c + end] for c in letter], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = Merges(
            [vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], [vocab[a + b] for a, b in pairs], range(len(pairs))
        )
        # what was met lately, and what was met before that
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {"": b""}
        self.old_words: dict[str, bytes] = {}
        self.old_units: dict[str, bytes] = {}

    def _learn_words(self, new: list[str]) -> None:
        raw = [w.encode() for w in new]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        ids, counts = self.merges.run(symbols, lengths)
        out, stop = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        self.words.update((w, out[a:b]) for w, a, b in zip(new, [0, *stop[:-1]], stop))

    def _learn(self, new: list[str]) -> None:
        """Plain words, also with a sign at the end, need no pattern and are told apart by the string methods alone."""
        lower = "\n".join(new).lower().split("\n")
        # flat lists: a tuple per unit would set the garbage collector going
        single, words_of_single, ended, words_of_ended, several, rest = [], [], [], [], [], []
        for u, low in zip(new, lower):
            if not u.isascii() and not PLAIN.fullmatch(u):
                rest.append(u)
            elif u.isalpha():
                single.append(u)
                words_of_single.append(low)
            elif u[-1] in SIGNS and u[:-1].isalpha():
                ended.append(u)
                words_of_ended.append(low[:-1])
            elif PLAIN.fullmatch(u):
                several.append(u)
            else:
                rest.append(u)
        cut = [self.cut(u.lower()) for u in several]
        unknown = _recalled(set(SIGNS).union(words_of_single, words_of_ended, *cut), self.words, self.old_words)
        for at in range(0, len(unknown), AT_ONCE):
            self._learn_words(unknown[at : at + AT_ONCE])
        get = self.words.__getitem__
        signs = {sign: get(sign) for sign in SIGNS}
        self.units.update(zip(single, map(get, words_of_single)))
        self.units.update(zip(ended, [get(w) + signs[u[-1]] for u, w in zip(ended, words_of_ended)]))
        self.units.update(zip(several, [b"".join(map(get, ws)) for ws in cut]))
        if rest:
            for u, e in zip(rest, self.library.encode_batch(rest, add_special_tokens=False)):
                self.units[u] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; null counts as empty."""
        if self.added and (special := {k: t for k, t in enumerate(texts) if t and any(a in t for a in self.added)}):
            out = self._encode([None if k in special else t for k, t in enumerate(texts)])
            for k, e in zip(special, self.default.encode_batch([*special.values()], add_special_tokens=False)):
                out[k] = np.array(e.ids, "<u4").tobytes()
            return out
        return self._encode(texts)

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") if t else [""] for t in texts]
        if len(self.units) > self.remember:
            self.units, self.old_units = {"": b""}, self.units
        if len(self.words) > self.remember:
            self.words, self.old_words = {}, self.words
        if new := _recalled(set().union(*split), self.units, self.old_units):
            self._learn(new)
        get = self.units.__getitem__
        return [b"".join(map(get, units)) for units in split]


def _recalled(wanted: set[str], known: dict[str, bytes], old: dict[str, bytes]) -> list[str]:
    """What of `wanted` is in neither table. What only the old one has comes over: the frequent stays when the old one is dropped."""
    missing = wanted.difference(known)
    if old and (again := missing.intersection(old)):
        known.update((x, old[x]) for x in again)
        missing -= again
    return list(missing)


def _byte_letters() -> list[str]:
    """The printable letter that byte-level tokenizers write for each byte: itself if visible, else one from U+0100 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(0x100 + hidden.index(b)) for b in range(256)]


@lru_cache(maxsize=1)
def word_bpe(path: str, added_tokens: bool = False, remember: int = CACHED) -> WordBpe:
    """The encoder of a file; a worker keeps the last one, with about `remember` units and words."""
    return WordBpe(path, added_tokens, remember)
