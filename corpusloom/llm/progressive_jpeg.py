"""Progressive JPEG: a byte payload kept in DCT coefficients, and a scan-accumulating decoder to RGB tensors.

The encoder puts payload byte b into quantised coefficient b - 128 (quantiser 1) of a three-component 4:2:0 image, so the
payload is lossless although the samples are not; the payload runs through all luma blocks in raster order, then Cb, then Cr.
Scans: DC first (one low bit kept back), AC 1-5 first (one low bit kept back), AC 6-63, AC 1-5 refinement, DC refinement.
Restart intervals are independent byte-aligned segments; segments of all images of a batch are coded and decoded in lockstep.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import chunks, integer_id, ranges, read_documents, scratch_path, text_bytes

UNIT = 576
#: Blocks (AC) or MCUs (DC) per restart interval, and segments worked on at once.
INTERVAL, SLICE = 4, 8192
#: Payload bytes per batch of images.
BATCH_BYTES = 2 << 20
LOW_BAND = 5
MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7]")


@lru_cache(1)
def zigzag() -> np.ndarray:
    """Raster position of each zigzag index."""
    cells = sorted(((i + j, i if (i + j) % 2 else j, i, j) for i in range(8) for j in range(8)))
    return np.array([i * 8 + j for *_, i, j in cells])


@lru_cache(1)
def basis() -> np.ndarray:
    """[zigzag index, pixel] inverse DCT scaled to integers: products and sums are exact in float64, in any order."""
    x = np.arange(8)
    c = np.array([[math.sqrt((1 if u == 0 else 2) / 8) * math.cos((2 * p + 1) * u * math.pi / 16) for p in x] for u in x])
    full = np.einsum("uy,vx->uvyx", c, c).reshape(64, 64)
    return np.rint(full[zigzag()] * (1 << 16))


# ---- Huffman tables --------------------------------------------------------------------------------------------------

#: Symbols by code length. Short codes for what a dense payload needs: no run, sizes 1 to 8.
DC_SYMBOLS = {4: list(range(12))}
AC_SYMBOLS = {
    4: list(range(1, 9)), 5: [0],
    9: [9, 10, *(r << 4 | s for r in range(1, 16) for s in range(11))],
}


def canonical(by_length: dict[int, list[int]]) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length)."""
    out, code, last = {}, 0, 0
    for length in sorted(by_length):
        code <<= length - last
        for s in by_length[length]:
            out[s] = (code, length)
            code += 1
        last = length
    return out


@lru_cache(4)
def code_arrays(kind: str) -> tuple[np.ndarray, np.ndarray]:
    codes, lengths = np.zeros(256, np.uint64), np.zeros(256, np.int64)
    for s, (c, n) in canonical(DC_SYMBOLS if kind == "dc" else AC_SYMBOLS).items():
        codes[s], lengths[s] = c, n
    return codes, lengths


@lru_cache(1)
def value_codes() -> tuple[np.ndarray, np.ndarray]:
    """Code and length of every AC symbol with its value bits, at [run << 11 | value + 1024]."""
    codes, lengths = code_arrays("ac")
    v = np.arange(-1024, 1024)
    size = _sizes(v)
    bits = np.where(v > 0, v, v + (1 << size) - 1).astype(np.uint64)
    symbol = np.arange(16)[:, None] << 4 | np.minimum(size, 10)
    return (codes[symbol] << size.astype(np.uint64) | bits).ravel(), (lengths[symbol] + size).ravel()


@lru_cache(64)
def lookup(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For every 16-bit window: code length (0: no code) and symbol, from a DHT body (16 counts, symbols)."""
    lengths, symbols = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    code, at = 0, 16
    for n in range(1, 17):
        for _ in range(table[n - 1]):
            lo = code << (16 - n)
            lengths[lo : lo + (1 << (16 - n))], symbols[lo : lo + (1 << (16 - n))] = n, table[at]
            code, at = code + 1, at + 1
        code <<= 1
    return lengths, symbols


@lru_cache(64)
def lookup_ac(table: bytes) -> np.ndarray:
    """For every 16-bit window, packed: value << 16 | slow << 13 | end of block << 12 | run << 5 | bits used.

    Slow entries (an end-of-band run, or a value that does not fit in the window) are resolved apart.
    """
    lengths, symbols = lookup(table)
    run, size, window = symbols >> 4, symbols & 15, np.arange(1 << 16)
    used = lengths + size
    bits = (window >> np.maximum(16 - used, 0)) & ((1 << size) - 1)
    value = np.where(bits >> np.maximum(size - 1, 0) & 1, bits, bits - (1 << size) + 1)
    value = np.where(size > 0, value, 0)
    slow = (lengths == 0) | (used > 16) | ((size == 0) & (run > 0) & (run < 15))
    end = (size == 0) & (run == 0)
    return (value << 16 | slow << 13 | end << 12 | np.where(end, 0, run) << 5 | np.minimum(used, 16)).astype(np.int32)


def _sizes(v: np.ndarray) -> np.ndarray:
    """Bit length of |v|."""
    return np.where(v == 0, 0, np.frexp(np.abs(v).astype(np.float64))[1]).astype(np.int64)


# ---- encoder ---------------------------------------------------------------------------------------------------------


@dataclass
class Grid:
    """Layout of a batch of images: MCU rows and columns, first block, blocks."""

    rows: np.ndarray
    cols: np.ndarray
    first: np.ndarray = field(init=False)
    total: int = field(init=False)

    def __post_init__(self):
        blocks = 6 * self.rows * self.cols
        self.first, self.total = np.cumsum(blocks) - blocks, int(blocks.sum())

    @classmethod
    def for_payloads(cls, sizes: np.ndarray) -> Grid:
        mcus = -(-sizes // 384)
        cols = np.maximum(np.floor(np.sqrt(mcus)).astype(np.int64), 1)
        return cls(-(-mcus // cols), cols)

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """(first block, blocks) of every component of every image."""
        m = self.rows * self.cols
        size = np.stack((4 * m, m, m), 1).ravel()
        return np.cumsum(size) - size, size

    def mcu_blocks(self) -> np.ndarray:
        """[MCU, 6] block numbers in interleaved order, over all images."""
        m = self.rows * self.cols
        own = np.repeat(np.arange(len(m)), m)
        i = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        cols = self.cols[own]
        r, c = i // cols, i % cols
        top = self.first[own] + 4 * r * cols + 2 * c
        chroma = self.first[own] + 4 * m[own] + i
        return np.stack((top, top + 1, top + 2 * cols, top + 2 * cols + 1, chroma, chroma + m[own]), 1)


def _segments(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut units of so many blocks into restart intervals: unit and size of each."""
    n = -(-sizes // INTERVAL)
    unit = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return unit, np.minimum(INTERVAL, sizes[unit] - nth * INTERVAL)


def _pack(code: np.ndarray, length: np.ndarray, segment: np.ndarray, n_segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of items (in order, with their segments) as bytes, each segment padded with ones; bytes per segment."""
    bits = np.bincount(segment, length, n_segments).astype(np.int64)
    size = -(-bits // 8)
    starts = (np.cumsum(size) - size) * 8
    run = np.cumsum(length) - length
    at = run + (starts - (np.cumsum(bits) - bits))[segment]
    word = at >> 5
    wide = code << (64 - (at & 31) - length).astype(np.uint64)
    total = int(size.sum())
    out = np.zeros(total // 4 + 3, np.uint32)
    if len(word):
        cut = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[cut]] |= np.bitwise_or.reduceat((wide >> np.uint64(32)).astype(np.uint32), cut)
        out[word[cut] + 1] |= np.bitwise_or.reduceat(wide.astype(np.uint32), cut)
    data = out.astype(">u4").view(np.uint8)[:total].copy()
    pad = size * 8 - bits
    full = size > 0
    data[(np.cumsum(size) - 1)[full]] |= ((1 << pad[full]) - 1).astype(np.uint8)
    return data, size


def _stuff(data: np.ndarray, size: np.ndarray, unit: np.ndarray, n_units: int) -> list[bytes]:
    """Byte-stuffed entropy data of each unit, its segments parted by RST0..7."""
    ff = (data == 255).astype(np.int64)
    first = np.concatenate(([True], unit[1:] != unit[:-1]))
    marked = np.cumsum(2 * ~first)
    seg_of = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(data)) + np.cumsum(ff) - ff + marked[seg_of]
    out = np.zeros(len(data) + int(ff.sum()) + int(marked[-1]), np.uint8)
    out[at] = data
    starts = np.cumsum(size) - size
    before = np.concatenate(([0], np.cumsum(ff)))
    place = (starts + before[starts] + marked)[~first] - 2
    nth = np.arange(len(unit)) - np.maximum.accumulate(np.where(first, np.arange(len(unit)), 0))
    out[place], out[place + 1] = 255, 0xD0 + (nth[~first] - 1) % 8
    length = np.bincount(unit, size + np.add.reduceat(np.append(ff, 0), np.minimum(starts, len(ff))) * (size > 0) + 2 * ~first, n_units).astype(np.int64)
    raw, ends = out.tobytes(), np.cumsum(length)
    return [raw[a:b] for a, b in zip((ends - length).tolist(), ends.tolist())]


def _by_slices(unit: np.ndarray, sizes: np.ndarray, items) -> tuple[np.ndarray, np.ndarray]:
    """Apply items(first block, last block) -> (code, length, block) per slice of segments and pack."""
    data, out = [], []
    ends = np.cumsum(sizes)
    for lo in range(0, len(sizes), SLICE):
        hi = min(lo + SLICE, len(sizes))
        a, b = int(ends[lo] - sizes[lo]), int(ends[hi - 1])
        code, length, block = items(a, b)
        d, s = _pack(code, length, np.repeat(np.arange(hi - lo), sizes[lo:hi])[block - a], hi - lo)
        data.append(d)
        out.append(s)
    return np.concatenate(data), np.concatenate(out)


def _ac_first(coef: np.ndarray, lo: int, hi: int, low: int):
    (codes, lengths), (whole_codes, whole_lengths) = code_arrays("ac"), value_codes()

    def items(a: int, b: int):
        v = coef[a:b, lo : hi + 1]
        if low:
            v = np.where(v < 0, -(-v >> low), v >> low)
        at = np.flatnonzero(v)
        row, col = np.divmod(at.astype(np.int32), np.int32(hi + 1 - lo))
        run = np.diff(col, prepend=np.int32(-1)) - 1
        fresh = np.flatnonzero(np.diff(row, prepend=np.int32(-1)))
        run[fresh] = col[fresh]
        entry = (run & 15) << 11 | (v.reshape(-1)[at].astype(np.int32) + 1024)
        code, length = whole_codes[entry], whole_lengths[entry]
        last = np.full(b - a, -1)
        last[row] = col
        ends = last < hi - lo
        skips = run >> 4
        n = np.bincount(row, 1 + skips, b - a).astype(np.int64) + ends
        start = np.cumsum(n) - n
        total = int(n.sum())
        eob_before = np.cumsum(ends) - ends
        place = np.cumsum(1 + skips) - 1 + eob_before[row]
        if total == len(at):
            return code, length, a + row.astype(np.int64)
        out_code, out_len = np.full(total, codes[0xF0], np.uint64), np.full(total, lengths[0xF0])
        out_code[place], out_len[place] = code, length
        tail = (start + n - 1)[ends]
        out_code[tail], out_len[tail] = codes[0], lengths[0]
        return out_code, out_len, a + np.repeat(np.arange(b - a), n)

    return items


def _ac_refine(coef: np.ndarray, lo: int, hi: int):
    """Refinement of the lowest bit of a band of at most 15 coefficients (so no run of 16 zeros arises)."""
    codes, lengths = code_arrays("ac")

    def items(a: int, b: int):
        c = coef[a:b, lo : hi + 1].astype(np.int64)
        size, bit = np.abs(c), (np.abs(c) & 1).astype(np.uint64)
        n, width = c.shape
        code, length = np.zeros((n, width + 1), np.uint64), np.zeros((n, width + 1), np.int64)
        run, held, n_held = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.int64)
        for k in range(width):
            old, new = size[:, k] > 1, size[:, k] == 1
            held = np.where(old, held << np.uint64(1) | bit[:, k], held)
            n_held = n_held + old
            symbol = run << 4 | 1
            sign = (c[:, k] > 0).astype(np.uint64)
            code[:, k] = np.where(new, (codes[symbol] << np.uint64(1) | sign) << n_held.astype(np.uint64) | held, 0)
            length[:, k] = np.where(new, lengths[symbol] + 1 + n_held, 0)
            run = np.where(new, 0, run + ~old)
            held, n_held = np.where(new, 0, held).astype(np.uint64), np.where(new, 0, n_held)
        left = (run > 0) | (n_held > 0)
        code[:, width] = np.where(left, codes[0] << n_held.astype(np.uint64) | held, 0)
        length[:, width] = np.where(left, lengths[0] + n_held, 0)
        return code.ravel(), length.ravel(), a + np.repeat(np.arange(n), width + 1)

    return items


def _header(rows: int, cols: int, size: int) -> bytes:
    seg = lambda marker, body: struct.pack(">BBH", 255, marker, len(body) + 2) + body
    table = lambda head, by: bytes([head, *(len(by.get(n, ())) for n in range(1, 17)), *(s for n in sorted(by) for s in by[n])])
    frame = struct.pack(">BHHB", 8, 16 * rows, 16 * cols, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    return b"\xff\xd8" + seg(0xFE, b"payload=%d" % size) + seg(0xDB, b"\0" + b"\1" * 64) + seg(0xC2, frame) + seg(0xC4, table(0, DC_SYMBOLS) + table(0x10, AC_SYMBOLS)) + seg(0xDD, struct.pack(">H", INTERVAL))


def _scan(components, lo: int, hi: int, high: int, low: int) -> bytes:
    body = bytes([len(components), *(x for c in components for x in (c, 0)), lo, hi, high << 4 | low])
    return struct.pack(">BBH", 255, 0xDA, len(body) + 2) + body


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """One progressive JPEG file per payload (each a positive multiple of 64 bytes)."""
    if not payloads:
        return []
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    grid = Grid.for_payloads(sizes)
    coef = np.zeros((grid.total, 64), np.int16)
    flat = np.frombuffer(b"".join(payloads), np.uint8)
    coef.reshape(-1)[ranges(grid.first * 64, sizes)] = flat.astype(np.int16) - 128
    n_files = len(payloads)

    # DC scans: interleaved, differences within an interval
    order = grid.mcu_blocks()
    dc = coef[order, 0].astype(np.int64)
    mcu_unit, mcu_sizes = _segments(grid.rows * grid.cols)
    fresh = np.zeros(len(dc), bool)
    fresh[np.cumsum(mcu_sizes) - mcu_sizes] = True
    high = dc >> 1
    luma = high[:, :4].ravel()
    before = np.concatenate(([0], luma[:-1]))
    before[np.flatnonzero(fresh) * 4] = 0
    diff = np.empty_like(high)
    diff[:, :4] = (luma - before).reshape(-1, 4)
    for k in (4, 5):
        was = np.concatenate(([0], high[:-1, k]))
        was[fresh] = 0
        diff[:, k] = high[:, k] - was
    codes, lengths = code_arrays("dc")

    def dc_items(a: int, b: int):
        v = diff[a:b].ravel()
        size = _sizes(v)
        bits = np.where(v > 0, v, v + (1 << size) - 1).astype(np.uint64)
        return codes[size] << size.astype(np.uint64) | bits, lengths[size] + size, a + np.repeat(np.arange(b - a), 6)

    def low_bits(a: int, b: int):
        return (dc[a:b].ravel() & 1).astype(np.uint64), np.ones((b - a) * 6, np.int64), a + np.repeat(np.arange(b - a), 6)

    dc_first = _stuff(*_by_slices(mcu_unit, mcu_sizes, dc_items), mcu_unit, n_files)
    dc_last = _stuff(*_by_slices(mcu_unit, mcu_sizes, low_bits), mcu_unit, n_files)
    unit, seg_sizes = _segments(grid.units()[1])
    scans = []
    for items in (_ac_first(coef, 1, LOW_BAND, 1), _ac_first(coef, LOW_BAND + 1, 63, 0), _ac_refine(coef, 1, LOW_BAND)):
        scans.append(_stuff(*_by_slices(unit, seg_sizes, items), unit, 3 * n_files))
    heads = [[_scan([c], *p) for c in (1, 2, 3)] for p in ((1, LOW_BAND, 0, 1), (LOW_BAND + 1, 63, 0, 0), (1, LOW_BAND, 1, 0))]
    first, last = _scan([1, 2, 3], 0, 0, 0, 1), _scan([1, 2, 3], 0, 0, 1, 0)
    out = []
    for i in range(n_files):
        parts = [_header(int(grid.rows[i]), int(grid.cols[i]), len(payloads[i])), first, dc_first[i]]
        for k in range(3):
            for c in range(3):
                parts += (heads[k][c], scans[k][3 * i + c])
        out.append(b"".join((*parts, last, dc_last[i], b"\xff\xd9")))
    return out


# ---- decoder ---------------------------------------------------------------------------------------------------------


@dataclass
class Image:
    """A parsed file: its frame, and its scans as (components, lo, hi, high, low, interval, tables, first byte, last byte)."""

    height: int = 0
    width: int = 0
    components: list[tuple[int, int, int]] = field(default_factory=list)  # id, h, v
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    quant_of: list[int] = field(default_factory=list)
    scans: list[tuple] = field(default_factory=list)
    comment: bytes = b""

    def shape(self, k: int) -> tuple[int, int, int]:
        """Blocks of component k: rows and columns in its own scans, and stored columns (whole MCUs)."""
        hm, vm = max(c[1] for c in self.components), max(c[2] for c in self.components)
        _, h, v = self.components[k]
        return -(-(-(-self.height * v // vm)) // 8), -(-(-(-self.width * h // hm)) // 8), -(-self.width // (8 * hm)) * h

    def mcus(self) -> tuple[int, int]:
        hm, vm = max(c[1] for c in self.components), max(c[2] for c in self.components)
        return -(-self.height // (8 * vm)), -(-self.width // (8 * hm))


def parse(data: bytes) -> Image:
    """Markers of a progressive file (8-bit, Huffman). ValueError: anything else, or a cut file."""
    image, at, interval, tables = Image(), 2, 0, {}
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    while True:
        if at + 4 > len(data) and data[at : at + 2] != b"\xff\xd9":
            raise ValueError("file ends early")
        marker = data[at + 1]
        if marker == 0xD9:
            return image
        size = struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFE:
            image.comment = body
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                image.quant[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[65 + 64 * wide :]
        elif marker == 0xC2:
            precision, image.height, image.width, n = struct.unpack_from(">BHHB", body)
            if precision != 8:
                raise ValueError("8-bit samples only")
            for k in range(n):
                c, hv, q = body[6 + 3 * k : 9 + 3 * k]
                image.components.append((c, hv >> 4, hv & 15))
                image.quant_of.append(q)
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a progressive Huffman frame")
        elif marker == 0xC4:
            while body:
                n = 17 + sum(body[1:17])
                tables[body[0]] = body[1:n]
                body = body[n:]
        elif marker == 0xDD:
            interval = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            n = body[0]
            ids = [c[0] for c in image.components]
            own = tuple(ids.index(body[1 + 2 * k]) for k in range(n))
            lo, hi, bits = body[1 + 2 * n : 4 + 2 * n]
            heads = tuple(tables.get((body[2 + 2 * k] >> 4) if lo == 0 else 0x10 | body[2 + 2 * k] & 15, b"") for k in range(n))
            m = MARKER.search(data, at)
            if not m:
                raise ValueError("file ends early")
            image.scans.append((own, lo, hi, bits >> 4, bits & 15, interval, heads, at, m.start()))
            at = m.start()


class _Bits:
    """Unstuffed entropy data of many segments: 16-bit windows at any bit."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray):
        """raw: concatenated scans, ``starts``: where each scan starts; every RST or scan start opens a segment."""
        ff = raw == 255
        after = np.concatenate(([False], ff[:-1]))
        after[starts] = False
        stuffed = after & (raw == 0)
        restart = after & (raw >= 0xD0) & (raw <= 0xD7)
        drop = stuffed | restart
        drop[:-1] |= restart[1:]
        opens = np.zeros(len(raw) + 1, bool)
        opens[starts] = True
        opens[np.flatnonzero(restart) + 1] = True
        kept = np.cumsum(~drop) - ~drop
        self.at = np.append(kept, int((~drop).sum()))[np.flatnonzero(opens)] * 8
        self.scan_of = np.searchsorted(starts, np.flatnonzero(opens), "right") - 1
        data = np.concatenate((raw[~drop], np.full(8, 255, np.uint8))).astype(np.uint32)
        self.window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        self.end = (len(self.window) - 2) * 8

    def peek(self, pos: np.ndarray) -> np.ndarray:
        return (self.window[pos >> 3] >> (16 - (pos & 7)).astype(np.uint32)) & np.uint32(0xFFFF)

    def read(self, pos: np.ndarray, n: np.ndarray) -> np.ndarray:
        """n (0 to 16) bits at pos."""
        return self.peek(pos).astype(np.int64) >> (16 - n)


def _extend(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(size == 0, 0, np.where(bits >> np.maximum(size - 1, 0) & 1, bits, bits - (1 << size) + 1))


def _decode_ac_first(coef, bits: _Bits, pos, order, left, table: bytes, lo: int, hi: int, low: int) -> None:
    """order: (blocks, index of each segment's first); ``left`` counts a segment's blocks down. A finished one goes on in the spare block."""
    fast, (lengths, symbols) = lookup_ac(table), lookup(table)
    blocks, at = order
    flat = coef.reshape(-1)
    k, place = np.full(len(pos), lo), blocks[at] * 64
    while len(pos):
        window = bits.peek(pos)
        e = fast[window]
        used, run, value = e & 31, (e >> 5) & 127, e >> 16
        end, eobs = (e & 0x1000) != 0, None
        slow = np.flatnonzero(e & 0x2000)
        if len(slow):
            n, s = lengths[window[slow]], symbols[window[slow]]
            size, r = s & 15, s >> 4
            band = (size == 0) & (r < 15)
            eobs = np.zeros(len(pos), np.int64)
            value[slow] = _extend(bits.read(pos[slow] + n, size), size)
            eobs[slow] = np.where(band, (1 << r) + bits.read(pos[slow] + n, np.where(band, r, 0)) - 1, 0)
            used[slow] = np.where(n == 0, 16, n + np.where(band, r, size))
            run[slow], end[slow] = np.where(band, 0, r), band
        k += run
        flat[place + np.minimum(k, 63)] = value << low  # an end writes the zero that is there
        pos += used
        k += 1
        over = np.flatnonzero(end | (k > hi))
        if len(over):
            step = 1 if eobs is None else 1 + eobs[over]
            left[over] -= step
            at[over] += step
            k[over] = lo
            done = left[over] <= 0
            if done.any():
                at[over[done]] = len(blocks) - 1
                if (left <= 0).mean() > 0.1:
                    live = left > 0
                    pos, at, left, k, place = pos[live], at[live], left[live], k[live], place[live]
                    place = blocks[at] * 64
                    continue
            place[over] = blocks[at[over]] * 64
            np.minimum(pos, bits.end, out=pos)
    coef[-1] = 0


def _decode_ac_refine(coef, bits: _Bits, pos, order, left, table: bytes, lo: int, hi: int, low: int) -> None:
    lengths, symbols = lookup(table)
    blocks, at = order
    flat, one = coef.reshape(-1), 1 << low
    n = len(pos)
    k, run, new, eobs, pending = np.full(n, lo), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    while len(pos):
        need = np.flatnonzero(~pending & (eobs == 0))
        if len(need):
            window = bits.peek(pos[need])
            used, s = np.maximum(lengths[window], 1), symbols[window]
            size, r = s & 15, s >> 4
            band = (size == 0) & (r < 15)
            p = pos[need] + used
            sign = bits.read(p, np.ones(len(p), np.int64))
            new[need] = np.where(size > 0, np.where(sign == 1, one, -one), 0)
            eobs[need] = np.where(band, (1 << r) + bits.read(p, np.where(band, r, 0)), 0)
            pos[need] = p + np.where(band, r, size > 0)
            run[need], pending[need] = r, ~band
        place = blocks[at] * 64 + k
        c = flat[place].astype(np.int64)
        old = c != 0
        bit = bits.read(pos, old.astype(np.int64))
        grow = old & (bit == 1) & ((np.abs(c) & one) == 0)
        hit = ~old & pending & (run == 0)
        flat[place] = np.where(grow, c + np.sign(c) * one, np.where(hit, new, c))
        run -= ~old & pending & (run > 0)
        pending &= ~hit
        pos = np.minimum(pos + old, bits.end)
        k = k + 1
        over = k > hi
        eobs -= over & (eobs > 0)
        pending &= ~over
        at, left = at + over, left - over
        k[over] = lo
        live = left > 0
        if not live.all():
            pos, at, left, k, run, new, eobs, pending = (x[live] for x in (pos, at, left, k, run, new, eobs, pending))


def _decode_dc(coef, bits: _Bits, pos, order, left, tables, of_slot, high: int, low: int) -> None:
    """order: ([MCU, slot] blocks, first MCU); of_slot: component (index into tables) of each slot."""
    blocks, at = order
    if high:
        for i in range(int(left.max(initial=0))):
            live = np.flatnonzero(left > i)
            for slot in range(len(of_slot)):
                p = pos[live] + i * len(of_slot) + slot
                coef[blocks[at[live] + i, slot], 0] |= (bits.read(np.minimum(p, bits.end), np.ones(len(p), np.int64)) << low).astype(np.int16)
        return
    last = np.zeros((len(tables), len(pos)), np.int64)
    for i in range(int(left.max(initial=0))):
        live = np.flatnonzero(left > i)
        for slot, c in enumerate(of_slot):
            lengths, symbols = lookup(tables[c])
            window = bits.peek(pos[live])
            size = symbols[window] & 15
            p = pos[live] + lengths[window]
            last[c, live] += _extend(bits.read(p, size), size)
            coef[blocks[at[live] + i, slot], 0] = (last[c, live] << low).astype(np.int16)
            pos[live] = np.minimum(p + size, bits.end)


def _storage(images: list[Image]) -> tuple[list[list[int]], int]:
    """First block of every component of every image in one coefficient array, and the blocks in all."""
    first, total = [], 0
    for im in images:
        own = []
        rows, _ = im.mcus()
        for k, (_, _, v) in enumerate(im.components):
            own.append(total)
            total += rows * v * im.shape(k)[2]
        first.append(own)
    return first, total


def _interleaved(im: Image, first: list[int], own: tuple[int, ...]) -> np.ndarray:
    rows, cols = im.mcus()
    r, c = np.divmod(np.arange(rows * cols), cols)
    slots = []
    for k in own:
        _, h, v = im.components[k]
        wide = im.shape(k)[2]
        slots += [first[k] + (r * v + y) * wide + c * h + x for y in range(v) for x in range(h)]
    return np.stack(slots, 1)


def decode_coefficients(files: list[bytes]) -> tuple[list[Image], np.ndarray, list[list[int]]]:
    """Accumulate all scans of all files: images, coefficients [block, zigzag] (a spare block last), first blocks."""
    images = [parse(f) for f in files]
    first, total = _storage(images)
    coef = np.zeros((total + 1, 64), np.int16)
    for nth in range(max((len(im.scans) for im in images), default=0)):
        groups = defaultdict(list)
        for i, im in enumerate(images):
            if nth < len(im.scans):
                own, lo, hi, high, low, _, heads, _, _ = im.scans[nth]
                groups[own, lo, hi, high, low, heads, tuple(im.components[k][1:] for k in own)].append(i)
        for (own, lo, hi, high, low, heads, factors), members in groups.items():
            orders, sizes, raw = [], [], []
            for i in members:
                im = images[i]
                scan = im.scans[nth]
                raw.append(files[i][scan[7] : scan[8]])
                if lo == 0 and len(own) > 1:
                    orders.append(_interleaved(im, first[i], own))
                else:
                    rows, cols, wide = im.shape(own[0])
                    orders.append((first[i][own[0]] + np.arange(rows)[:, None] * wide + np.arange(cols)).reshape(-1, 1))
                sizes.append((len(orders[-1]), scan[5] or len(orders[-1])))
            lengths = np.fromiter(map(len, raw), np.int64, len(raw))
            bits = _Bits(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(lengths) - lengths)
            n, each = np.array(sizes).T
            nth_segment = np.arange(len(bits.at)) - np.searchsorted(bits.scan_of, bits.scan_of)
            base = (np.cumsum(n) - n)[bits.scan_of]
            start = nth_segment * each[bits.scan_of]
            left = np.minimum(each[bits.scan_of], n[bits.scan_of] - start)
            blocks = np.concatenate(orders)
            if lo:
                blocks = np.append(blocks[:, 0], total)
            for a in range(0, len(left), SLICE):
                s = slice(a, a + SLICE)
                live = left[s] > 0
                pos, at, rest = bits.at[s][live].copy(), (base + start)[s][live], left[s][live]
                if lo == 0:
                    of_slot = [j for j, (h, v) in enumerate(factors) for _ in range(h * v if len(own) > 1 else 1)]
                    _decode_dc(coef, bits, pos, (blocks, at), rest, heads, of_slot, high, low)
                elif high:
                    _decode_ac_refine(coef, bits, pos, (blocks, at), rest, heads[0], lo, hi, low)
                else:
                    _decode_ac_first(coef, bits, pos, (blocks, at), rest, heads[0], lo, hi, low)
    return images, coef, first


def samples(coef: np.ndarray) -> np.ndarray:
    """Inverse transform of [block, zigzag] (dequantised) coefficients to 8-bit samples [block, 8, 8]."""
    out = np.empty((len(coef), 64), np.uint8)
    for lo in range(0, len(coef), 4096):
        x = coef[lo : lo + 4096].astype(np.float64) @ basis()
        out[lo : lo + 4096] = np.clip(np.floor((x + (1 << 15)) / (1 << 16)) + 128, 0, 255)
    return out.reshape(-1, 8, 8)


def rgb_tensor(im: Image, blocks: np.ndarray, first: list[int]) -> np.ndarray:
    """[height, width, 3] of one image from all sample blocks; chroma is upsampled by repetition. One component: grey."""
    hm, vm = max(c[1] for c in im.components), max(c[2] for c in im.components)
    rows, _ = im.mcus()
    planes = []
    for k, (_, h, v) in enumerate(im.components[:3]):
        wide, high = im.shape(k)[2], rows * v
        plane = blocks[first[k] : first[k] + high * wide].reshape(high, wide, 8, 8).swapaxes(1, 2).reshape(high * 8, wide * 8)
        if (vm // v, hm // h) != (1, 1):
            plane = plane.repeat(vm // v, 0).repeat(hm // h, 1)
        planes.append(plane[: im.height, : im.width].astype(np.int32))
    if len(planes) < 3:
        return np.repeat(planes[0].astype(np.uint8)[:, :, None], 3, 2)
    y, cb, cr = planes[0] << 16, planes[1] - 128, planes[2] - 128
    # fixed values: 1.402, 0.344136, 0.714136, 1.772 in units of 1/65536
    half = 1 << 15
    r, g, b = y + 91881 * cr + half, y - 22553 * cb - 46802 * cr + half, y + 116130 * cb + half
    return np.clip(np.stack((r, g, b), 2) >> 16, 0, 255).astype(np.uint8)


def decode_files(files: list[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """(RGB tensor, payload) of every file; the payload is empty for files of other makers."""
    images, coef, first = decode_coefficients(files)
    scaled = coef
    if any(q != 1 for im in images for t in im.quant.values() for q in t.tolist()):
        scaled = coef.astype(np.int32)
        for im, own in zip(images, first):
            for k, q in enumerate(im.quant_of):
                end = own[k] + im.mcus()[0] * im.components[k][2] * im.shape(k)[2]
                scaled[own[k] : end] *= im.quant[q].astype(np.int32)
    blocks = samples(scaled[:-1])
    raw = (coef[:-1] + 128).astype(np.uint8).reshape(-1)
    for im, own in zip(images, first):
        m = re.fullmatch(rb"payload=([0-9]+)", im.comment)
        size = int(m[1]) if m else 0
        yield rgb_tensor(im, blocks, own), raw[own[0] * 64 : own[0] * 64 + size].tobytes()


def padded(text: bytes) -> bytes:
    """The text with bytes 255 up to a positive multiple of 576."""
    return text + b"\xff" * (max(UNIT, -(-len(text) // UNIT) * UNIT) - len(text))


def tensor_feature(rgb: np.ndarray) -> str:
    """Size, mean colour and CRC-32 of a tensor."""
    mean = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64) // (rgb.shape[0] * rgb.shape[1])
    return f"{rgb.shape[1]}x{rgb.shape[0]}:{mean[0]}-{mean[1]}-{mean[2]}:{zlib.crc32(rgb.tobytes()):08x}"


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): the padded text of every row as a progressive JPEG file. Null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for s in chunks(texts, BATCH_BYTES):
                files = encode_payloads([padded(t) for t in texts[s]])
                n = pa.array([len(t) for t in texts[s]], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.start, s.stop - s.start), n, pa.array(files, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(integer_id(docs, id_col).alias("doc_id"), text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def decode_media(files: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """(doc_id, height, width, rgb, payload): full-resolution RGB tensors (row-major bytes). Null or unreadable media give null columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    rgb, payload = next(decode_files([media or b""]))
                    row = (doc_id, rgb.shape[0], rgb.shape[1], rgb.tobytes(), payload)
                except (ValueError, IndexError, struct.error):
                    row = (doc_id, None, None, None, None)
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["doc_id", "height", "width", "rgb", "payload"])

    return files.select(integer_id(files, id_col).alias("doc_id"), media_col).mapInArrow(run, "doc_id long, height int, width int, rgb binary, payload binary")


def store_media(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_media`` written as a table below ``path`` and read back: Spark's committer makes it whole when executors are lost."""
    encode_media(docs, id_col, text_col).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def digests_of(files: DataFrame) -> DataFrame:
    """Digests of the stored files (doc_id, n_bytes, media): of the file, the payload decoded from it and the RGB tensor.

    Batches are cut by bytes, and within a batch by restart intervals, so a very long text is coded in slices.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media = batch.column(2).to_pylist()
            for s in chunks(media, BATCH_BYTES):
                rows = [
                    (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(f), hashlib.sha256(f).hexdigest(), tensor_feature(rgb))
                    for f, (rgb, p) in zip(media[s], decode_files(media[s]))
                ]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                own = [batch.column(k).slice(s.start, s.stop - s.start) for k in range(2)]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return files.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as media in the shared folder, read the stored bytes back and return their digests.

    No shuffle. All arithmetic is on integers: equal texts give equal rows whatever batch they fall in. Null and empty texts are one unit
    of padding, texts of any length are stored whole, repeated rows get a row each, an empty table gives none; other columns are not read.
    """
    return digests_of(store_media(docs, scratch_path(docs.sparkSession, "media"), id_col, text_col))


def op1_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns over all documents."""
    return media_digests(read_documents(spark, sf_dir))
