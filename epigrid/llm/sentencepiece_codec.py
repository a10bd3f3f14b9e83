"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file gives the pieces, their scores and the byte pieces. Two neighbouring symbols merge if their joined text is a
piece; the higher score goes first, then the place further left. Texts are cut where no piece can reach across (before a
space that follows other text, and at line ends), every different unit of a batch is merged once, and a bounded cache
keeps units between batches.

Null texts count as empty, an empty text has no ids. Repeated rows, null ids and further columns change nothing: only
the named columns are read, and each row is answered for itself. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from epigrid.llm.bpe import Merges
from epigrid.llm.common import slices

SPACE = "▁"
CACHED_UNITS = 300_000
SLOW = re.compile(r"\n[^ \n]*| +[^ \n]*|[^ \n]+")


class Codec:
    """Encoder and decoder of one model file: byte fallback, identity normalisation and a space put before the text."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        n, t = model.normalizer_spec, model.trainer_spec
        if not (
            t.model_type == 2 and t.byte_fallback and n.add_dummy_prefix and n.escape_whitespaces
            and not n.remove_extra_whitespaces and not n.precompiled_charsmap and not t.treat_whitespace_as_suffix
        ):
            raise ValueError("only BPE models with byte fallback and identity normalisation are supported")
        normal, spelled, skipped = 1, 6, (2, 3)
        if any(p.type not in (normal, spelled, *skipped) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        self.id_of: dict[str, int] = {}
        for i, p in enumerate(model.pieces):
            if p.type == spelled:
                self.byte_id[int(p.piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == normal:
                self.id_of[p.piece] = i
                self.bytes_of.append(p.piece.replace(SPACE, " ").encode())
            else:
                self.bytes_of.append(b"")
        crossing = [p for p in self.id_of if re.search(f"[^{SPACE}]{SPACE}|\n.|.\n", p)]
        if crossing:
            raise ValueError(f"pieces reach across units: {crossing[:3]}")
        score = {i: model.pieces[i].score for i in self.id_of.values()}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        pairs = [
            (self.id_of[p[:k]], self.id_of[p[k:]], i, rank[score[i]])
            for p, i in self.id_of.items()
            for k in range(1, len(p))
            if p[:k] in self.id_of and p[k:] in self.id_of
        ]
        self.merges = Merges(*zip(*pairs))
        self.name_of = [str(i) for i in range(len(self.bytes_of))]
        #: Piece of each single character; a character that is none stays itself as a negative number and never merges.
        self.symbol_of = -1 - np.arange(0x110000, dtype=np.int64)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        self.units: dict[str, tuple[int, str, bytes]] = {}

    def _split(self, text: str) -> list[str]:
        """Units of a text; one that follows a single space goes without it."""
        if "  " not in text and text[0] != " ":
            return text.replace("\n", " \n").split(" ")
        return [u[1:] if u[0] == " " and u[1:2] != " " else u for u in SLOW.findall(" " + text)]

    def _learn(self, new: list[str]) -> None:
        spelled = [(u if u[:1] == "\n" or u[:2] == "  " else " " + u).replace(" ", SPACE) for u in new]
        lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
        points = np.frombuffer("".join(spelled).encode("utf-32-le"), np.uint32)
        symbols, counts = self.merges.run(self.symbol_of[points], lengths)
        foreign = {int(s): chr(-1 - int(s)).encode() for s in np.flatnonzero(np.bincount(-symbols[symbols < 0])) * -1}
        size = {s: len(raw) for s, raw in foreign.items()}
        name = {s: ",".join(str(self.byte_id[b]) for b in raw) for s, raw in foreign.items()}
        symbols, ends = symbols.tolist(), np.cumsum(counts).tolist()
        names = [self.name_of[s] if s >= 0 else name[s] for s in symbols]
        raws = [self.bytes_of[s] if s >= 0 else foreign[s] for s in symbols]
        sizes = np.cumsum([0, *(1 if s >= 0 else size[s] for s in symbols)])
        starts = [0, *ends[:-1]]
        totals = (sizes[ends] - sizes[starts]).tolist()
        join, glue = ",".join, b"".join
        self.units.update(
            (unit, (n, join(names[a:b]), glue(raws[a:b]))) for unit, n, a, b in zip(new, totals, starts, ends)
        )

    def encode_units(self, texts: list[str | None]) -> list[list[tuple[int, str, bytes]]]:
        """For each text its units as (number of ids, ids as text, decoded bytes)."""
        split = [self._split(t.replace(SPACE, " ")) if t else [] for t in texts]
        if len(self.units) > CACHED_UNITS:
            self.units = {}
        new = set().union(*split).difference(self.units) if split else set()
        if new:
            self._learn(list(new))
        get = self.units.__getitem__
        return [list(map(get, units)) for units in split]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for _, ids, _ in self.encode_units([text])[0] for i in ids.split(",")]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes that are not UTF-8 become U+FFFD, and the space put before the text goes."""
        data = b"".join([self.bytes_of[i] for i in ids])
        return _undo_prefix(data).decode("utf-8", "replace")


def _undo_prefix(data: bytes) -> bytes:
    return data[1:] if data[:1] == b" " else data


@lru_cache(maxsize=2)
def codec(model_path: str) -> Codec:
    return Codec(model_path)


def encode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of every text: (id, ids array<int>)."""

    def run(batches):
        model = codec(model_path)
        for batch in batches:
            ids = [
                [int(i) for _, s, _ in units for i in s.split(",")]
                for part in slices(batch.column(1).to_pylist())
                for units in model.encode_units(part)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=names)

    names = [id_column, "ids"]
    picked = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    return picked.mapInArrow(run, f"`{id_column}` {dict(picked.dtypes)[id_column]}, ids array<int>")


def digests(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: number of ids, SHA-256 of the decimal ids joined by commas and of the decoded text in UTF-8."""

    def run(batches):
        model = codec(model_path)
        sha = hashlib.sha256
        for batch in batches:
            n, ids, decoded = [], [], []
            for units in (u for part in slices(batch.column(1).to_pylist()) for u in model.encode_units(part)):
                counts, spelled, raw = zip(*units) if units else ((), (), ())
                n.append(sum(counts))
                ids.append(sha(",".join(spelled).encode()).hexdigest())
                decoded.append(sha(_undo_prefix(b"".join(raw))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=names,
            )

    names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"]
    picked = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    kind = dict(picked.dtypes)[id_column]
    return picked.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
