"""Vectorised text primitives over Arrow buffers: pieces, words, rolling hashes.

Hashes are polynomials modulo 2**64 with an odd base. An odd base has an inverse, so the
hash of any span follows from two prefix sums and one multiplication, for all spans of
a piece at once. Documents are worked on in pieces of about a megabyte (a longer document
is a piece of its own), which bounds the memory of a task by its longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_WORD = (1 << 64) - 1
PIECE_BYTES = 1 << 20

#: The bytes that separate words: tab to carriage return, and space.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Powers:
    """Powers of an odd base and of its inverse, extended as longer pieces come."""

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = np.ones(1, dtype=U64)
        self.down = np.ones(1, dtype=U64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(self.inverse, size, 1 << 64))])


BYTE_POWERS = Powers(0x9E3779B97F4A7C15)
WORD_POWERS = (Powers(0xC2B2AE3D27D4EB4F), Powers(0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Prefix sums for ``span_hash``; one element more than ``values``."""
    powers.reach(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers.up[: len(values)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts, ends, powers: Powers) -> np.ndarray:
    """Hash of values[start:end] for each pair; equal spans have equal hashes anywhere."""
    return (sums[ends] - sums[starts]) * powers.down[starts]


def window_hash(sums: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` values."""
    count = len(sums) - width
    if count <= 0:
        return np.zeros(0, dtype=U64)
    return (sums[width:] - sums[:-width]) * powers.down[:count]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    if len(x) < width:
        return x[:0]
    span, low = 1, x
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    return low


class Piece:
    """Some consecutive rows of a batch: ``data`` holds their bytes, ``edges`` their borders."""

    def __init__(self, first: int, data: np.ndarray, edges: np.ndarray):
        self.first, self.data, self.edges = first, data, edges
        self.rows = len(edges) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.edges[row] : self.edges[row + 1]].tobytes()

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the index of each row's first word (and the end)."""
        if not len(self.data):
            none = np.zeros(0, dtype=np.int64)
            return none, none, np.zeros(self.rows + 1, dtype=np.int64)
        solid = ~_SPACE[self.data]
        begins, finishes = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        finishes[:-1] &= ~solid[1:]
        heads = self.edges[:-1][np.diff(self.edges) > 0]
        tails = self.edges[1:][np.diff(self.edges) > 0] - 1
        begins[heads] = solid[heads]
        finishes[tails] = solid[tails]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        return starts, ends, np.searchsorted(starts, self.edges)

    def word_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = prefix(self.data.astype(U64), BYTE_POWERS)
        raw = span_hash(sums, starts, ends, BYTE_POWERS)
        return mix(raw + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def raw_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column and its int64 offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.zeros(0, dtype=np.uint8) if buffer is None else np.frombuffer(buffer, dtype=np.uint8)
    return data, offsets


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[Piece]:
    """The rows of a column in order, cut into pieces of at most ``size`` bytes or one row."""
    if not len(column):
        return
    data, offsets = raw_column(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), rows)
        lo, hi = offsets[row], offsets[end]
        yield Piece(row, data[lo:hi], offsets[row : end + 1] - lo)
        row = end


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def list_array(values: np.ndarray, edges, kind: pa.DataType) -> pa.ListArray:
    """Row r holds values[edges[r]:edges[r + 1]]."""
    return pa.ListArray.from_arrays(
        pa.array(np.asarray(edges, dtype=np.int32)), pa.array(values, type=kind)
    )


def runs(positions: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans [start, end) covered by the windows that begin at sorted ``positions``."""
    if not len(positions):
        return positions, positions
    breaks = np.flatnonzero(np.diff(positions) > width) + 1
    starts = positions[np.concatenate([[0], breaks])]
    ends = positions[np.concatenate([breaks - 1, [len(positions) - 1]])] + width
    return starts, ends
