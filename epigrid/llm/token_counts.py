"""Token counts of whole texts by a tokenizer's own library, lengths only.

Arrow batches are cut into runs of rows of about equal bytes, so a batch given to the library is small whatever the texts are. A
text longer than a piece is split at safe boundaries, a single space between two ASCII letters, where no token and no rule of the
tokenizer reaches across; the counts of its pieces add up to that of the whole text. Pieces are split further at such boundaries (at every space
and line end where the file drops white space) into units, and the library encodes every different unit of a run of rows once. Files
for which safe boundaries can't be told from their own description are encoded whole. `.json` files are for the `tokenizers` library, `.model` files for `sentencepiece`; strings of
special tokens inside a text count as the library has it by default; nothing is added, cut off or padded.

Null texts count as empty: no bytes, no tokens. Null and repeated ids, repeated rows and further columns change nothing: only the
named columns are read and every row is answered for itself. An empty table gives no rows. A very long text without a safe boundary
is encoded in one piece.
"""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import count as count_from, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: Bytes of text given to the library at once, and characters of a piece of a long text.
BATCH_BYTES = 256 << 10
PIECE_CHARACTERS = 64 << 10
#: Units whose counts a worker remembers.
CACHED_UNITS = 200_000
BOUNDARY = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
BEFORE_SPACE = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
#: Normalisers that work character by character, or compose characters, and so never look across a space between letters.
LOCAL_STEPS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}


class Counter:
    """Counts tokens of texts by a library.

    `units` splits a piece of text where no token reaches across; without it texts are counted whole. `gap` characters of a cut between
    pieces are left out.
    """

    def __init__(self, count: Callable[[list[str]], list[int]], units: Callable[[str], list[str]] | None, gap: int):
        self.count, self.units, self.gap = count, units, gap
        self._forget()

    def _forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count_from().__next__)
        self.sizes = np.zeros(0, np.int64)

    def pieces(self, text: str, size: int = PIECE_CHARACTERS) -> Iterator[str]:
        """A long text in pieces that end at a safe boundary."""
        start = 0
        while self.units and len(text) - start > size and (found := BOUNDARY.search(text, start + size)):
            yield text[start : found.start()]
            start = found.start() + self.gap
        yield text[start:]

    def _in_batches(self, parts: Iterable[str], batch_bytes: int) -> list[int]:
        """Tokens of every part; the library gets about `batch_bytes` at once."""
        out, batch, held = [], [], 0
        for part in parts:
            batch.append(part)
            held += len(part)
            if held >= batch_bytes:
                out += self.count(batch)
                batch, held = [], 0
        return out + self.count(batch) if batch else out

    def lengths(self, texts: list[str | None], batch_bytes: int = BATCH_BYTES) -> np.ndarray:
        """Tokens of every text. A unit that stands in several places is encoded once; a bounded number of units is remembered."""
        if not self.units:
            return np.array(self._in_batches((t or "" for t in texts), batch_bytes), np.int64)
        if len(self.number) > CACHED_UNITS:
            self._forget()
        row, codes = [], []
        for i, text in enumerate(texts):
            for piece in self.pieces(text) if text else ():
                units = self.units(piece)
                row.append(i)
                codes.append(np.fromiter(map(self.number.__getitem__, units), np.int32, len(units)))
        new = self._in_batches(islice(self.number, len(self.sizes), None), batch_bytes)
        self.sizes = np.concatenate([self.sizes, np.array(new, np.int64)])
        out = np.zeros(len(texts), np.int64)
        np.add.at(out, np.array(row, np.int64), np.array([self.sizes[c].sum() for c in codes], np.int64))
        return out


def _no_white_space(pattern: str) -> bool:
    """True if no match of the pattern holds white space: literal letters, letter and number classes, and classes without it."""
    literal = re.sub(r"\[\^\\s[^\]]*\]|\\p\{[LN]\}|[\[\]+|]", "", pattern)
    return not re.search(r"[\\\s.^()]", literal)


def _from_json(path: str) -> Counter:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def steps(part: dict | None, inner: str) -> list[dict]:
        return [] if part is None else part[inner] if part["type"] == "Sequence" else [part]

    normal, split = steps(spec["normalizer"], "normalizers"), steps(spec["pre_tokenizer"], "pretokenizers")
    local = all(s["type"] in LOCAL_STEPS or s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in normal)
    spelled = bool(split) and split[-1]["type"] == "ByteLevel" and not split[-1]["add_prefix_space"]
    # either only words are cut out, or a space belongs to the word after it
    dropped = (
        spelled and len(split) == 2 and split[0]["type"] == "Split" and split[0]["invert"] and split[0]["behavior"] == "Removed"
        and _no_white_space(split[0]["pattern"].get("Regex", " "))
    )
    by_bytes = spelled and len(split) == 1 and split[0]["use_regex"]
    plain = all(not re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    safe = local and plain and not spec["model"].get("dropout")
    words = lambda text: text.replace("\n", " ").split(" ")
    units = words if safe and dropped else BEFORE_SPACE.split if safe and by_bytes else None
    return Counter(lambda part: [len(e) for e in library.encode_batch_fast(part, add_special_tokens=False)], units, 0)


def _from_model(path: str) -> Counter:
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    normal, trained = model.normalizer_spec, model.trainer_spec
    across = any(re.search("[^▁]▁| ", p.piece) for p in model.pieces)
    cuttable = (
        trained.model_type == 2 and not across and not normal.precompiled_charsmap and normal.escape_whitespaces
        and normal.add_dummy_prefix and not trained.treat_whitespace_as_suffix
    )
    # the library puts a space before every piece, so the one at the cut is left out
    units = BOUNDARY.split if cuttable else None
    return Counter(lambda part: [len(ids) for ids in library.encode(part, num_threads=1)], units, 1)


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """The counter of a tokenizer file; a worker keeps only the last one."""
    if path.endswith(".json"):
        return _from_json(path)
    if path.endswith(".model"):
        return _from_model(path)
    raise ValueError(f"neither a .json nor a .model file: {path}")


def balanced(sizes: np.ndarray, most: int = 16 * BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of rows that hold about `most` bytes each."""
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield begin, end
        begin = end


def counts(
    docs: DataFrame, tokenizer: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row."""

    def run(batches):
        library = counter(tokenizer)
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            tokens = np.zeros(len(sizes), np.int64)
            for begin, end in balanced(sizes):
                tokens[begin:end] = library.lengths(texts.slice(begin, end - begin).to_pylist())
            columns = [batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_column, "n_bytes", "n_tokens", "over_limit"]
    picked = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    return picked.mapInArrow(run, f"`{id_column}` {dict(picked.dtypes)[id_column]}, n_bytes long, n_tokens long, over_limit boolean")
