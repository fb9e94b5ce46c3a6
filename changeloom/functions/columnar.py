"""Records of many rows at once: fields as runs of bytes, put together and taken apart by arrays.

`Piece` holds, for every row, a run of bytes (maybe none). Records are made by laying the pieces of all fields side by
side, and read by walking the fields in order with one position for each row.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64


class Piece(NamedTuple):
    size: np.ndarray  # bytes of each row
    data: np.ndarray  # of all rows, one after the other


def _ramp(size: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n of size."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def constant(raw: bytes, rows: int) -> Piece:
    return Piece(np.full(rows, len(raw), np.int64), np.tile(np.frombuffer(raw, np.uint8), rows))


def varints(n: np.ndarray) -> Piece:
    """Zig-zag numbers of seven bits a byte."""
    n = n.astype(np.int64)
    z = ((n << 1) ^ (n >> 63)).view(U64)
    size = np.ones(len(z), np.int64)
    for k in range(1, 10):
        size += (z >> U64(7 * k)) != 0
    width = int(size.max(initial=1))
    out = np.empty((len(z), width), np.uint8)
    for k in range(width):
        out[:, k] = ((z >> U64(7 * k)) & U64(127)).astype(np.uint8) | ((size > k + 1).astype(np.uint8) << 7)
    return Piece(size, out[np.arange(width) < size[:, None]])


def fixed(values: np.ndarray) -> Piece:
    raw = np.ascontiguousarray(values)
    return Piece(np.full(len(raw), raw.itemsize, np.int64), raw.view(np.uint8).reshape(-1))


def texts(column: pa.Array) -> Piece:
    """Length and bytes of strings or binaries; a null is an empty one."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    size = np.diff(off)
    return joined([varints(size), Piece(size, raw)])


def given(values: list[bytes]) -> Piece:
    return Piece(np.array([len(v) for v in values], np.int64), np.frombuffer(b"".join(values), np.uint8))


def only(piece: Piece, where: np.ndarray) -> Piece:
    """The runs of some rows; the others have none."""
    return Piece(np.where(where, piece.size, 0), piece.data[np.repeat(where, piece.size)])


def optional(piece: Piece, valid: np.ndarray) -> Piece:
    """A union of null and a type: the branch, and the value where there is one."""
    branch = Piece(np.ones(len(valid), np.int64), np.where(valid, 2, 0).astype(np.uint8))
    return joined([branch, only(piece, valid)])


def joined(pieces: list[Piece]) -> Piece:
    """The runs of each row side by side."""
    total = np.sum([p.size for p in pieces], axis=0)
    out = np.empty(int(total.sum()), np.uint8)
    at = np.cumsum(total) - total
    for p in pieces:
        out[np.repeat(at, p.size) + _ramp(p.size)] = p.data
        at = at + p.size
    return Piece(total, out)


def grouped(piece: Piece, count: np.ndarray) -> Piece:
    """Runs of a row's list as one run, for lists of `count` elements that lie one after the other."""
    edge = np.concatenate([[0], np.cumsum(count)])
    return Piece(np.diff(np.concatenate([[0], np.cumsum(piece.size)])[edge]), piece.data)


def binary(piece: Piece, valid: np.ndarray | None = None) -> pa.Array:
    """As binary values, null where not valid."""
    if valid is not None:
        piece = only(piece, valid)
    off = np.concatenate([[0], np.cumsum(piece.size)]).astype(np.int64)
    nulls = None if valid is None else pa.array(valid).buffers()[1]
    large = pa.Array.from_buffers(pa.large_binary(), len(piece.size), [nulls, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(piece.data))])
    return large.cast(pa.binary())


class Walk:
    """Records of all rows, read field by field; rows of `on` take part in a step, the others stay where they are."""

    def __init__(self, column: pa.Array, skip: int):
        column = column.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        # Steps may look beyond the last record, though no value comes from there.
        self.data = np.concatenate([np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), np.zeros(16, np.uint8)])
        self.at = off[:-1] + skip
        self.rows = len(column)

    def numbers(self, on: np.ndarray) -> np.ndarray:
        """A zig-zag number of each row of `on`, 0 for the others."""
        out, todo, shift = np.zeros(self.rows, U64), np.flatnonzero(on), 0
        while len(todo):
            byte = self.data[self.at[todo]]
            out[todo] |= (byte & 127).astype(U64) << U64(shift)
            self.at[todo] += 1
            todo, shift = todo[byte >= 128], shift + 7
        return (out >> U64(1)).view(np.int64) ^ -(out & U64(1)).view(np.int64)

    def fixed(self, on: np.ndarray, kind: str) -> np.ndarray:
        size = np.dtype(kind).itemsize
        out = np.zeros(self.rows, kind)
        rows = np.flatnonzero(on)
        out[rows] = np.ascontiguousarray(self.data[self.at[rows][:, None] + np.arange(size)]).view(kind).reshape(-1)
        self.at[rows] += size
        return out

    def texts(self, on: np.ndarray, kind: pa.DataType) -> pa.Array:
        size = np.where(on, self.numbers(on), 0)
        data = self.data[np.repeat(self.at, size) + _ramp(size)]
        self.at = self.at + size
        off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        large = pa.large_string() if pa.types.is_string(kind) else pa.large_binary()
        return pa.Array.from_buffers(large, self.rows, [pa.array(on).buffers()[1], pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))]).cast(kind)

    def branch(self, on: np.ndarray) -> np.ndarray:
        return on & (self.numbers(on) == 1)

    def lists(self, on: np.ndarray, names: list[str]) -> pa.Array:
        """An array of enum symbols."""
        count, parts, rows = np.zeros(self.rows, np.int64), [], []
        more = on.copy()
        while True:
            n = self.numbers(more)
            more &= n != 0
            if not more.any():
                break
            self.numbers(more & (n < 0))  # a block with its size in bytes, which isn't needed
            left = np.abs(np.where(more, n, 0))
            count += left
            while (left > 0).any():
                parts.append(self.numbers(left > 0)[left > 0])
                rows.append(np.flatnonzero(left > 0))
                left = np.maximum(left - 1, 0)
        symbol = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        order = np.argsort(np.concatenate(rows), kind="stable") if rows else np.zeros(0, np.int64)
        values = pa.array(names, pa.string()).take(pa.array(symbol[order]))
        off = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(off), values)
