"""Polygon texts of many rings at once. Formatting coordinate by coordinate in the engine is what a query of buffers spends its time on."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from epigrid.functions.rings import ring_wkt

HEAD, GAP, BETWEEN, TAIL = (np.frombuffer(t, np.uint8) for t in (b"POLYGON((", b" ", b", ", b"))"))
UNIT = 10**9


def ring_texts(ring: Column) -> Column:
    """The same text as `ring_wkt`, formatted in batches; rings with a null, a non-finite, or a very small or large coordinate are left to it."""
    return F.coalesce(F.arrow_udf(texts_of, "string")(ring), ring_wkt(ring))


def texts_of(rings: pa.Array) -> pa.Array:
    sizes = np.asarray(rings.value_lengths().fill_null(0), np.int64)
    vertices = rings.flatten()
    x, y = (np.asarray(vertices.field(n).fill_null(np.nan), float) for n in "xy")
    owner = np.repeat(np.arange(len(rings)), sizes)
    # far from numbers whose text could have an exponent, and from those beyond 18 digits
    plain = (np.abs(x) > 0.01) & (np.abs(x) < 1e8) & (np.abs(y) > 0.01) & (np.abs(y) < 1e8)
    if vertices.null_count:
        plain &= np.asarray(vertices.is_valid())
    good = (sizes > 0) & (np.bincount(owner, weights=~plain, minlength=len(rings)) == 0)
    x, y, owner = (a[good[owner]] for a in (x, y, owner))
    first = np.r_[True, owner[1:] != owner[:-1]][: len(owner)]
    last = np.r_[owner[1:] != owner[:-1], True][: len(owner)]
    shown = [(HEAD, first), _digits(x), (GAP, None), _digits(y), (BETWEEN, ~last), (TAIL, last)]
    chars, kept = [], []
    for block, use in shown:
        block = np.broadcast_to(block, (len(x), block.shape[-1]))
        use = np.ones(len(x), bool) if use is None else use
        chars.append(block)
        kept.append(np.broadcast_to(use if use.ndim == 2 else use[:, None], block.shape))
    chars, kept = np.concatenate(chars, 1), np.concatenate(kept, 1)
    lengths = np.bincount(owner, weights=kept.sum(1), minlength=len(rings)).astype(np.int64)
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    valid = pa.py_buffer(np.packbits(good, bitorder="little"))
    return pa.StringArray.from_buffers(len(rings), pa.py_buffer(offsets), pa.py_buffer(chars[kept]), valid)


def _digits(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of numbers with nine decimals, rounded half up, and which of them are shown."""
    units = np.floor(value * 1e9 + 0.5).astype(np.int64)
    whole, part = np.divmod(np.abs(units), UNIT)
    wide = len(str(whole.max(initial=0)))
    chars = np.empty((len(value), wide + 11), np.uint8)
    shown = np.ones(chars.shape, bool)
    chars[:, 0], shown[:, 0], chars[:, wide + 1] = ord("-"), units < 0, ord(".")
    for number, start, width in ((whole, 1, wide), (part, wide + 2, 9)):
        rest = number.astype(np.uint32)
        for place in range(start + width - 1, start - 1, -1):
            rest, digit = rest // 10, rest % 10
            chars[:, place] = digit + ord("0")
    for place in range(1, wide):
        shown[:, place] = whole >= 10 ** (wide - place)
    return chars, shown
