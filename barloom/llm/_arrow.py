"""Arrow arrays from numpy buffers.

``pyarrow.array`` imports pandas into every worker, which costs it some 50 MB.
"""

from __future__ import annotations

from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa

_KINDS = {np.dtype("int64"): pa.int64(), np.dtype("int32"): pa.int32(), np.dtype("float64"): pa.float64()}


def numbers(values, kind=np.int64) -> pa.Array:
    flat = np.ascontiguousarray(values, dtype=kind)
    return pa.Array.from_buffers(_KINDS[flat.dtype], len(flat), [None, pa.py_buffer(flat)])


def flags(values) -> pa.Array:
    bits = np.packbits(np.asarray(values, dtype=bool), bitorder="little")
    return pa.Array.from_buffers(pa.bool_(), len(values), [None, pa.py_buffer(bits)])


def _offsets(sizes) -> pa.Buffer:
    return pa.py_buffer(np.fromiter(accumulate(sizes, initial=0), dtype=np.int32))


def binaries(values: list[bytes | None]) -> pa.Array:
    valid = None
    if None in values:
        valid = pa.py_buffer(np.packbits(np.fromiter((v is not None for v in values), dtype=bool, count=len(values)), bitorder="little"))
        values = [v or b"" for v in values]
    return pa.Array.from_buffers(pa.binary(), len(values), [valid, _offsets(map(len, values)), pa.py_buffer(b"".join(values))])


def _ends(strings: pa.Array) -> np.ndarray:
    return np.frombuffer(strings.buffers()[1], dtype=np.int32, count=len(strings) + 1, offset=4 * strings.offset) if len(strings) else np.zeros(1, np.int32)


def items(strings: pa.Array, groups: pa.Array | None = None) -> list[bytes]:
    """The bytes of the values of an array without nulls, or of those of each list of ``groups`` together."""
    ends = _ends(strings) if groups is None else _ends(strings)[_ends(groups)]
    data = strings.buffers()[2]
    raw = data.to_pybytes() if data else b""
    return [raw[lo:hi] for lo, hi in pairwise(ends.tolist())]


def lists(values: list, kind=np.int64) -> pa.Array:
    flat = np.concatenate([np.empty(0, kind), *[np.asarray(v, dtype=kind) for v in values]])
    child = numbers(flat, kind)
    return pa.Array.from_buffers(pa.list_(child.type), len(values), [None, _offsets(map(len, values))], children=[child])
