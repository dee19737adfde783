"""Static range asymmetric numeral system over symbols, many interleaved lanes at a time.

A block of symbols is dealt out to LANES lanes in turn. Lane states are 64-bit numbers in [2**31, 2**63);
a state that would grow too large first gives up its low 32 bits as a word. Encoding runs from the last
symbol to the first, so that decoding runs forward. All blocks share one frequency table and nothing
else, so each can be decoded alone. Within a block, a checkpoint holds the lane states and the place in the
words at every CHECKPOINT-th symbol: decoding may start at any of them.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 1024
CHECKPOINT = 1 << 18
#: Frequencies add up to 2**PRECISION.
PRECISION = 20
_LOW = np.uint64(1 << 31)
_32 = np.uint64(32)
_MAGIC = b"RNS1"
_HEAD = struct.Struct("<4sQII")


class Corrupt(ValueError):
    """A block whose checksum or length does not fit its content."""


def normalized(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Frequencies that add up to 2**precision, in proportion to counts; at least 1 where a count is over 0.

    All counts may be 0; then symbol 0 gets everything.
    """
    counts = np.asarray(counts, np.float64)
    total, size = counts.sum(), 1 << precision
    seen = counts > 0
    if total == 0:
        out = np.zeros(len(counts), np.int64)
        out[0] = size
        return out
    if seen.sum() > size:
        raise ValueError(f"{int(seen.sum())} symbols need a precision over {precision}")
    out = np.where(seen, np.maximum(1, np.floor(counts * (size - seen.sum()) / total)), 0).astype(np.int64)
    # What is left goes to the most frequent symbol, which feels it least.
    out[int(np.argmax(counts))] += size - out.sum()
    return out


class Table:
    """Frequencies of the symbols 0, 1, ... with their cumulative sums and the symbol of every slot."""

    def __init__(self, frequencies: np.ndarray, precision: int = PRECISION) -> None:
        freq = np.asarray(frequencies, np.int64)
        if freq.sum() != 1 << precision:
            raise ValueError("frequencies do not add up")
        self.precision = np.uint64(precision)
        self.mask = np.uint64((1 << precision) - 1)
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        # A state at or above this must give up a word before it takes in the symbol.
        self.most = self.freq << np.uint64(63 - precision)


def encode(symbols: np.ndarray, table: Table) -> bytes:
    """One block: head, checkpoints, words, checksum. Symbols must have a frequency over 0."""
    symbols = np.asarray(symbols, np.int64)
    n = len(symbols)
    if n and (symbols.min() < 0 or symbols.max() >= len(table.freq) or not table.freq[symbols].all()):
        raise ValueError("a symbol has no frequency")
    freq, start, most = table.freq[symbols], table.start[symbols], table.most[symbols]
    state = np.full(LANES, _LOW, np.uint64)
    words: list[np.ndarray] = []
    written, marks = 0, []
    for at in range((n - 1) // LANES * LANES, -1, -LANES) if n else ():
        f, c, top = freq[at : at + LANES], start[at : at + LANES], most[at : at + LANES]
        x = state[: len(f)]
        over = x >= top
        if over.any():
            out = x[over].astype(np.uint32)
            words.append(out)
            written += len(out)
            x[over] >>= _32
        quotient = x // f
        x[:] = (quotient << table.precision) + (x - quotient * f) + c
        if at % CHECKPOINT == 0:
            marks.append((written, state.copy()))
    words.reverse()
    body = np.concatenate(words) if words else np.empty(0, np.uint32)
    marks.reverse()
    # Words before a mark, counted from the front.
    places = np.array([written - w for w, _ in marks], "<u4")
    states = np.concatenate([s for _, s in marks]) if marks else np.empty(0, np.uint64)
    data = _HEAD.pack(_MAGIC, n, len(marks), len(body)) + places.tobytes() + states.astype("<u8").tobytes() + body.astype("<u4").tobytes()
    return data + struct.pack("<I", zlib.crc32(data))


def decode(data: bytes, table: Table, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Symbols start to stop of a block, read from the nearest checkpoint before. Raises Corrupt."""
    if len(data) < _HEAD.size + 4 or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise Corrupt("the checksum does not fit")
    magic, n, n_marks, n_words = _HEAD.unpack_from(data)
    if magic != _MAGIC or len(data) != _HEAD.size + n_marks * (4 + 8 * LANES) + 4 * n_words + 4:
        raise Corrupt("not a block of this format")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.empty(0, np.uint32)
    mark = start // CHECKPOINT
    places = np.frombuffer(data, "<u4", n_marks, _HEAD.size)
    state = np.frombuffer(data, "<u8", LANES, _HEAD.size + 4 * n_marks + 8 * LANES * mark).astype(np.uint64)
    words = np.frombuffer(data, "<u4", n_words, _HEAD.size + n_marks * (4 + 8 * LANES))
    first, place = mark * CHECKPOINT, int(places[mark])
    out = np.empty(min(-(-(stop - first) // LANES) * LANES, n - first), np.uint32)
    for at in range(0, len(out), LANES):
        x = state[: min(LANES, len(out) - at)]
        slot = x & table.mask
        symbols = table.symbol[slot]
        out[at : at + LANES] = symbols
        x[:] = table.freq[symbols] * (x >> table.precision) + slot - table.start[symbols]
        low = np.flatnonzero(x < _LOW)
        if len(low):
            x[low] = (x[low] << _32) | words[place : place + len(low)]
            place += len(low)
    return out[start - first : stop - first]
