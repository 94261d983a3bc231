"""Texts to tokens as numpy arrays, a batch at a time, for use inside tasks.

A token is a run of letters, digits and bytes above 127, or a run of other visible characters.
Nothing is done per token in Python: a token's hash is a difference of two prefix sums.
"""

from __future__ import annotations

import numpy as np

SPACE, MARK, LOWER, UPPER, DIGIT = 0, 1, 2, 3, 4

_KIND = np.full(256, MARK, dtype="u1")
_KIND[[9, 10, 11, 12, 13, 32]] = SPACE
_KIND[ord("a") : ord("z") + 1] = LOWER
_KIND[ord("A") : ord("Z") + 1] = UPPER
_KIND[ord("0") : ord("9") + 1] = DIGIT
_KIND[128:] = LOWER

_GROUP = np.where(_KIND <= MARK, _KIND, 2).astype("u1")

_VALUE = np.random.Generator(np.random.Philox(20)).integers(1, 1 << 63, 256, dtype="u8")
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))

_powers = [np.ones(1, "u8"), np.ones(1, "u8")]


def _power(n: int):
    if len(_powers[0]) < n:
        for k, base in enumerate((_STEP, _BACK)):
            steps = np.full(n, base, dtype="u8")
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype="u8")
    return _powers[0][:n], _powers[1][:n]


def mixed(x, salt: int = 0):
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Tokens:
    """Tokens of the texts of an Arrow string column: `doc` (row of the column), `hash`, `mark`
    (no letter or digit in it), `upper`, `length`, `first_upper`."""

    def __init__(self, texts):
        import pyarrow as pa

        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], dtype="i8")[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        start = int(offsets[0])
        raw = np.frombuffer(data, dtype="u1")[start : int(offsets[-1])] if data is not None else np.zeros(0, "u1")
        offsets = offsets - start
        self.texts = len(texts)
        n = len(raw)
        group = _GROUP[raw]
        border = np.empty(n + 1, dtype=bool)
        border[0] = border[-1] = True
        np.not_equal(group[1:], group[:-1], out=border[1:-1]) if n else None
        border[offsets] = True
        cuts = np.flatnonzero(border)
        starts, ends = cuts[:-1], cuts[1:]
        seen = group[starts] != SPACE if n else np.zeros(0, bool)
        starts, ends = starts[seen], ends[seen]
        power, back = _power(n + 1)
        sums = np.zeros(n + 1, dtype="u8")
        np.cumsum(_VALUE[raw] * power[:n], out=sums[1:])
        self.hash = mixed((sums[ends] - sums[starts]) * back[starts])
        kinds = _KIND[raw]
        uppers = np.zeros(n + 1, dtype="i4")
        np.cumsum(kinds == UPPER, out=uppers[1:])
        self.upper = uppers[ends] - uppers[starts]
        self.length = ends - starts
        self.mark = group[starts] == MARK
        self.digit = kinds[starts] == DIGIT
        self.first_upper = kinds[starts] == UPPER
        self.doc = np.searchsorted(offsets, starts, "right") - 1
        # the last offset repeats for empty texts at the end; a start lies before the end anyway
