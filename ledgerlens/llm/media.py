"""Media columns: progressive JPEG in binary columns, decoded to full-resolution RGB tensors.

Scans of spectral selection and successive approximation are accumulated into coefficient arrays; numpy inverts the
transform, chroma is brought to full size and colours are converted. Codes are walked one after another, each from
where the one before ends; what they mean is then worked out for a whole scan at once. Only refinements of AC bands,
whose codes depend on the coefficients so far, are worked out code by code. ``pack`` stores bytes losslessly in the
format's own unit, the quantised coefficient, and ``unpack`` reads them back from a decoded file.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Zigzag order of the 64 coefficients of a block, as places row by row.
ZIGZAG = np.array([8 * i + j for i, j in sorted(((i, j) for i in range(8) for j in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))])


def _inverse_dct() -> np.ndarray:
    """Matrix from 64 coefficients in zigzag order to 64 samples row by row."""
    x = np.arange(8)
    one = np.cos((2 * x[:, None] + 1) * x[None, :] * np.pi / 16) * np.where(x == 0, np.sqrt(0.125), 0.5)
    return np.kron(one, one)[:, ZIGZAG].T.astype(np.float32)


INVERSE = _inverse_dct()
MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


@dataclass
class Component:
    ident: int
    h: int
    v: int
    table: int
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros((0, 0, 64), np.int32))
    rows: int = 0
    columns: int = 0


@dataclass
class Image:
    width: int = 0
    height: int = 0
    components: list[Component] = field(default_factory=list)
    quantisers: dict[int, np.ndarray] = field(default_factory=dict)
    comments: list[bytes] = field(default_factory=list)

    def rgb(self) -> np.ndarray:
        """Height x width x 3 samples; chroma samples are repeated to full size."""
        return tensors_of([self])[0]


def tensors_of(images: list[Image]) -> list[np.ndarray]:
    """The samples of several images, of which all blocks are transformed at once."""
    parts = [(c.coefficients * i.quantisers[c.table]).reshape(-1, 64) for i in images for c in i.components]
    samples = np.clip(np.rint(np.concatenate(parts).astype(np.float32) @ INVERSE) + 128, 0, 255)
    out, at = [], 0
    for image in images:
        planes = []
        hs, vs = max(c.h for c in image.components), max(c.v for c in image.components)
        for c in image.components:
            rows, columns, _ = c.coefficients.shape
            part, at = samples[at : at + rows * columns], at + rows * columns
            plane = part.reshape(rows, columns, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, columns * 8)
            plane = plane.repeat(vs // c.v, axis=0).repeat(hs // c.h, axis=1) if (hs, vs) != (c.h, c.v) else plane
            planes.append(plane[: image.height, : image.width])
        if len(planes) == 1:
            out.append(np.repeat(planes[0][:, :, None], 3, axis=2).astype(np.uint8))
            continue
        y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
        colour = np.empty((*y.shape, 3), np.float32)
        colour[:, :, 0], colour[:, :, 1], colour[:, :, 2] = y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb
        out.append(np.clip(np.rint(colour), 0, 255).astype(np.uint8))
    return out


class Huffman:
    """A table: symbols in code order, and for every 16 bits the symbol they begin with and its length."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.symbols, self.counts = symbols, counts
        self.symbol, self.length = np.zeros(65536, np.int32), np.zeros(65536, np.int32)
        code = k = 0
        for bits, n in enumerate(counts, 1):
            for _ in range(n):
                at = code << (16 - bits)
                self.symbol[at : at + (1 << (16 - bits))] = symbols[k]
                self.length[at : at + (1 << (16 - bits))] = bits
                code, k = code + 1, k + 1
            code <<= 1
        # bits from the start of an AC code to the next: extra bits are as many as the size, or as the run of an end of band
        run, size = self.symbol >> 4, self.symbol & 15
        extra = np.where(size > 0, size, np.where(run < 15, run, 0))
        self.stride = np.where(self.length > 0, self.length + extra, 255).astype(np.uint8)
        self.step = np.minimum(self.length + self.symbol, 255).astype(np.uint8)  # the same for a DC code
        # what an AC code adds to the place in its band: nothing where it ends the band
        self.size, self.advance = size, np.where(size > 0, run + 1, np.where(run == 15, 16, 0))
        # bits to the end of the last of four codes that 16 bits hold whole, and how many these are
        self.leap, self.count = self.stride.astype(np.int32), np.ones(65536, np.int64)
        for k in range(1, 4):
            further = self.stride[(np.arange(65536) << np.minimum(self.leap, 16)) & 0xFFFF]
            fits = (self.count == k) & (self.leap + further <= 16)
            self.leap, self.count = self.leap + np.where(fits, further, 0), self.count + fits
        self.leap = self.leap.astype(np.uint8)

    def walk(self, w: np.ndarray, scans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Where each code begins, from the 16 bits at each place, and where each scan's codes end among these."""
        leaps, starts, stops = self.leap[w].tobytes(), [], []
        put = starts.append
        for p, end in scans:
            while p < end:
                put(p)
                p += leaps[p]
            stops.append(len(starts))
        at = np.array(starts, np.int64)
        count = self.count[w[at]]
        last = np.cumsum(count)
        first, out, ends = last - count, np.empty(int(last[-1]), np.int64), last[np.array(stops) - 1]
        k = 0
        while len(at):
            out[first + k] = at
            more = count > k + 1
            at, first, count, k = at[more] + self.stride[w[at[more]]], first[more], count[more], k + 1
        return out, ends


_HALF, _FULL = np.array([0, *(1 << np.arange(16))]), (1 << np.arange(17)) - 1


def _extend(value, size):
    """Signed values from their extra bits."""
    return value - _FULL[size] * (value < _HALF[size])


def _windows(datas: list[bytes]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The 16 bits from each bit of the scans, in a row, and the bits of each; zeros follow each scan."""
    spans, at = [], 0
    for d in datas:
        spans.append((8 * at, 8 * (at + len(d))))
        at += len(d) + 8
    b = np.frombuffer(b"".join([x for d in datas for x in (d, bytes(8))]), np.uint8).astype(np.int32)
    three = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((three[:, None] >> (8 - np.arange(8))) & 0xFFFF).ravel(), spans


def _dc(datas: list[bytes], orders: list[np.ndarray], tables: list[Huffman], high: int, low: int) -> list[np.ndarray]:
    """For each scan what its blocks' first coefficients get; ``orders``: component and block, in coded order."""
    if high:
        return [np.unpackbits(np.frombuffer(d, np.uint8))[: len(o)].astype(np.int32) << low for d, o in zip(datas, orders, strict=True)]
    w, spans = _windows(datas)
    steps = {id(t): t.step[w].tobytes() for t in {id(t): t for t in tables}.values()}
    steps, places = [steps[id(t)] for t in tables], []
    for (p, end), order in zip(spans, orders, strict=True):
        for c in order[:, 0].tolist():
            if p >= end:
                raise ValueError("a scan ends early")
            places.append(p)
            p += steps[c][p]
    places, component = np.array(places, np.int64), np.concatenate([o[:, 0] for o in orders])
    edges = np.cumsum([0, *map(len, orders)])
    value = np.zeros(len(places), np.int64)
    for c, table in enumerate(tables):
        mine = np.flatnonzero(component == c)
        here = w[places[mine]]
        size, after = table.symbol[here], w[places[mine] + table.length[here]]
        total = np.cumsum(_extend(after >> (16 - size), size))
        # differences begin anew with each scan
        begin = np.searchsorted(mine, edges)
        value[mine] = total - np.repeat(np.concatenate([[0], total])[begin[:-1]], np.diff(begin))
    return [value[a:b] << low for a, b in zip(edges, edges[1:], strict=False)]


def _ac_first(datas: list[bytes], counts: list[int], table: Huffman, band: int, low: int) -> np.ndarray:
    """The bands of all blocks of several scans, of ``counts`` blocks each."""
    w, spans = _windows(datas)
    places, stops = table.walk(w, spans)
    here = w[places]
    size, after, advance = table.size[here], w[places + table.length[here]], table.advance[here]
    # places in the band, all blocks in a row: sums of runs, from which each end of band jumps to the start of a block
    done = np.cumsum(advance)
    ends = np.flatnonzero(advance == 0)
    run = table.symbol[here[ends]] >> 4
    at, blocks = done[ends].tolist(), ((1 << run) + (after[ends] >> (16 - run))).tolist()
    starts, where, jumps, k, base = [0, *stops[:-1].tolist()], [], [], 0, 0
    before, split = np.concatenate([[0], done])[starts].tolist(), np.searchsorted(ends, stops).tolist()
    order = ends.tolist()
    for first, total, upto, n in zip(starts, before, split, counts, strict=True):
        shift = base * band - total
        where.append(first)
        jumps.append(shift)
        for k in range(k, upto):
            shift = ((at[k] + shift) // band + blocks[k]) * band - at[k]
            where.append(order[k])
            jumps.append(shift)
        k, base = upto, base + n
    done += np.repeat(jumps, np.diff(np.array([*where, len(done)])))
    coded = size > 0
    base = 0
    for first, stop, n in zip(starts, stops.tolist(), counts, strict=True):
        base += n
        used = first + int(np.searchsorted(done[first:stop], base * band)) + 1
        if used > stop:
            raise ValueError("a scan ends early")
        coded[used:stop] = False
    coded = np.flatnonzero(coded)
    size = size[coded]
    if not table.length[here[coded]].all():
        raise ValueError("no such code")
    out = np.zeros(base * band, np.int32)
    out[done[coded] - 1] = _extend(after[coded] >> (16 - size), size) << low
    return out.reshape(base, band)


def _ac_refine(datas: list[bytes], bands: list[np.ndarray], table: Huffman, low: int) -> list[list[list[int]]]:
    """The bands of each scan's blocks with one bit more."""
    step, out = 1 << low, []
    w, spans = _windows(datas)
    symbols, lengths, bit, word = table.symbol[w].tolist(), table.length[w].tolist(), (w >> 15).tolist(), w.tolist()
    for (p, n), values in zip(spans, bands, strict=True):
        rows, skip, band = values.tolist(), 0, values.shape[1]
        for row in rows:
            k = 0
            if not skip:
                while k < band:
                    if p >= n or not lengths[p]:
                        raise ValueError("a scan ends early")
                    run, size = divmod(symbols[p], 16)
                    p, new = p + lengths[p], 0
                    if size:
                        new = step if bit[p] else -step
                        p += 1
                    elif run < 15:
                        skip = (1 << run) + (word[p] >> (16 - run))
                        p += run
                        break
                    while k < band:
                        x = row[k]
                        if x:
                            if bit[p] and not abs(x) & step:
                                row[k] = x + step if x > 0 else x - step
                            p += 1
                        elif run:
                            run -= 1
                        else:
                            row[k] = new
                            k += 1
                            break
                        k += 1
                    if p > n:
                        raise ValueError("a scan ends early")
            if skip:
                for k in range(k, band):
                    x = row[k]
                    if x:
                        if p >= n:
                            raise ValueError("a scan ends early")
                        if bit[p] and not abs(x) & step:
                            row[k] = x + step if x > 0 else x - step
                        p += 1
                skip -= 1
        out.append(rows)
    return out


@lru_cache(maxsize=512)
def _order(down: int, across: int, parts: tuple[tuple[int, ...], ...]) -> np.ndarray:
    """Component and place of the blocks of a scan: unit of the scan x block of the unit x 2."""
    if len(parts) == 1:
        _, _, rows, columns, wide = parts[0]
        places = (np.arange(rows)[:, None] * wide + np.arange(columns)[None, :]).reshape(-1, 1)
        return np.stack([np.zeros_like(places), places], axis=2)
    units = []
    for i, (h, v, _, _, wide) in enumerate(parts):
        y = np.arange(down)[:, None, None, None] * v + np.arange(v)[None, None, :, None]
        x = np.arange(across)[None, :, None, None] * h + np.arange(h)[None, None, None, :]
        at = (y * wide + x).reshape(down * across, h * v)
        units.append(np.stack([np.full_like(at, i), at], axis=2))
    return np.concatenate(units, axis=1)


@dataclass
class Scan:
    """A scan as a file has it: its components by number, their tables, the band, the bits, and the coded data."""

    components: tuple[int, ...]
    tables: tuple[Huffman | None, ...]
    band: tuple[int, int]
    high: int
    low: int
    restart: int
    data: bytes

    def pieces(self, image: Image) -> list[tuple[bytes, np.ndarray]]:
        """The data between restarts, with the components and blocks of each in coded order."""
        hs, vs = max(c.h for c in image.components), max(c.v for c in image.components)
        across, down = -(-image.width // (8 * hs)), -(-image.height // (8 * vs))
        parts = [image.components[i] for i in self.components]
        order = _order(down, across, tuple((c.h, c.v, c.rows, c.columns, c.coefficients.shape[1]) for c in parts))
        if not self.restart:
            return [(self.data.replace(b"\xff\x00", b"\xff"), order.reshape(-1, 2))]
        pieces = [(p.replace(b"\xff\x00", b"\xff"), order[k * self.restart : (k + 1) * self.restart].reshape(-1, 2)) for k, p in enumerate(re.split(rb"\xff[\xd0-\xd7]", self.data))]
        return [p for p in pieces if len(p[1])]


def _accumulate(group: list[tuple[Image, Scan]]) -> None:
    """Put scans of one kind into the coefficients of their images."""
    scan = group[0][1]
    pieces = [(image, *p) for image, s in group for p in s.pieces(image)]
    datas, orders = [p[1] for p in pieces], [p[2] for p in pieces]
    if scan.band[0] == 0:
        for (image, _, order), value in zip(pieces, _dc(datas, orders, list(scan.tables), scan.high, scan.low), strict=True):
            for c, i in enumerate(scan.components):
                mine = order[:, 0] == c if len(scan.components) > 1 else slice(None)
                flat = image.components[i].coefficients.reshape(-1, 64)
                if scan.high:
                    flat[order[mine, 1], 0] |= value[mine]
                else:
                    flat[order[mine, 1], 0] = value[mine]
        return
    columns = slice(scan.band[0], scan.band[1] + 1)
    views = [image.components[scan.components[0]].coefficients.reshape(-1, 64) for image, _, _ in pieces]
    rows = [slice(None) if len(o) == len(v) else o[:, 1] for o, v in zip(orders, views, strict=True)]
    if scan.high:
        for view, row, new in zip(views, rows, _ac_refine(datas, [v[r, columns] for v, r in zip(views, rows, strict=True)], scan.tables[0], scan.low), strict=True):
            view[row, columns] = new
    else:
        new, at = _ac_first(datas, [len(o) for o in orders], scan.tables[0], scan.band[1] - scan.band[0] + 1, scan.low), 0
        for view, row, order in zip(views, rows, orders, strict=True):
            view[row, columns], at = new[at : at + len(order)], at + len(order)


def _parsed(data: bytes) -> tuple[Image, list[Scan]]:
    """The empty image and the scans of a progressive JPEG."""
    image, scans, dc, ac, restart, at = Image(), [], {}, {}, 0, 2
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    while at < len(data):
        kind = data[at + 1]
        if kind == 0xD9:
            break
        (size,) = struct.unpack(">H", data[at + 2 : at + 4])
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if kind == 0xDB:
            while body:
                wide = 2 if body[0] >> 4 else 1
                image.quantisers[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.int32)
                body = body[1 + 64 * wide :]
        elif kind == 0xC4:
            while body:
                n = sum(body[1:17])
                (ac if body[0] >> 4 else dc)[body[0] & 15] = _table(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif kind == 0xC2:
            image.height, image.width = struct.unpack(">HH", body[1:5])
            image.components = [Component(body[i], body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, 6 + 3 * body[5], 3)]
            hs, vs = max(c.h for c in image.components), max(c.v for c in image.components)
            across, down = -(-image.width // (8 * hs)), -(-image.height // (8 * vs))
            for c in image.components:
                c.columns, c.rows = -(-(-(-image.width * c.h // hs)) // 8), -(-(-(-image.height * c.v // vs)) // 8)
                c.coefficients = np.zeros((down * c.v, across * c.h, 64), np.int32)
        elif kind in (0xC0, 0xC1, *range(0xC3, 0xC4), *range(0xC5, 0xC8), *range(0xC9, 0xD0)):
            raise ValueError("not a progressive JPEG with Huffman codes")
        elif kind == 0xDD:
            (restart,) = struct.unpack(">H", body)
        elif kind == 0xFE:
            image.comments.append(body)
        elif kind == 0xDA:
            found = MARKER.search(data, at)
            end = found.start() if found else len(data)
            n = body[0]
            by = {c.ident: k for k, c in enumerate(image.components)}
            first, last, bits = body[1 + 2 * n : 4 + 2 * n]
            tables = tuple((ac.get(body[2 + 2 * i] & 15) if first else dc.get(body[2 + 2 * i] >> 4)) for i in range(n))
            scans.append(Scan(tuple(by[body[1 + 2 * i]] for i in range(n)), tables, (first, last), bits >> 4, bits & 15, restart, data[at:end]))
            at = end
    return image, scans


def decode_all(files: list[bytes]) -> list[Image]:
    """Coefficients of progressive JPEGs after all of their scans; scans of one kind are worked out together."""
    parsed = [_parsed(f) for f in files]
    for k in range(max((len(s) for _, s in parsed), default=0)):
        groups: dict[tuple, list[tuple[Image, Scan]]] = {}
        for image, scans in parsed:
            if k < len(scans):
                s = scans[k]
                groups.setdefault((s.components, tuple(map(id, s.tables)), s.band, s.high, s.low), []).append((image, s))
        for group in groups.values():
            _accumulate(group)
    return [image for image, _ in parsed]


def decode(data: bytes) -> Image:
    return decode_all([data])[0]


_TABLES: dict[tuple[bytes, bytes], Huffman] = {}


def _table(counts: bytes, symbols: bytes) -> Huffman:
    if (counts, symbols) not in _TABLES:
        if len(_TABLES) > 64:
            _TABLES.clear()
        _TABLES[counts, symbols] = Huffman(counts, symbols)
    return _TABLES[counts, symbols]


def _segment(kind: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, kind, len(body) + 2) + body


def _code_lengths(weights: dict[int, float]) -> dict[int, int]:
    """Huffman's lengths for symbols by weight, with one code left over, as no code may be all ones."""
    heap = [(w, i, (s,)) for i, (s, w) in enumerate(sorted(weights.items()))] + [(0.0, -1, (-1,))]
    lengths = dict.fromkeys([*weights, -1], 0)
    heapq.heapify(heap)
    while len(heap) > 1:
        (a, _, x), (b, i, y) = heapq.heappop(heap), heapq.heappop(heap)
        for s in x + y:
            lengths[s] += 1
        heapq.heappush(heap, (a + b, i, x + y))
    del lengths[-1]
    return lengths


def _huffman(weights: dict[int, float]) -> tuple[tuple[bytes, bytes], np.ndarray, np.ndarray]:
    """A table as a file has it, and the code and length of each symbol."""
    lengths = _code_lengths(weights)
    symbols = sorted(lengths, key=lambda s: (lengths[s], s))
    counts = bytes(sum(n == bits for n in lengths.values()) for bits in range(1, 17))
    code, before, codes, sizes = 0, 0, np.zeros(256, np.int64), np.zeros(256, np.int64)
    for s in symbols:
        code <<= lengths[s] - before
        codes[s], sizes[s], before = code, lengths[s], lengths[s]
        code += 1
    return (counts, bytes(symbols)), codes, sizes


#: Bytes of ``pack`` from the most frequent in text on; a byte's rank gives its coefficient: 0, 1, -1, 2, -2, ...
_FIRST = b" etaoinsrhldcumfpgwybvk,.\n-T0S1AI2CEMPWBDRHNL'x"
RANKED = np.array([*_FIRST, *sorted(set(range(256)) - set(_FIRST), key=lambda b: (b > 127, b))], np.uint8)
_VALUE = np.zeros(256, np.int32)
_VALUE[RANKED] = [(r + 1) // 2 * (1 if r % 2 else -1) for r in range(256)]
_SIZE = np.frexp(np.arange(512, dtype=np.float64))[1].astype(np.int64)

#: Tables of ``pack``: DC sizes; runs and sizes of AC codes, with ends of band; and those of a refined band.
_DC = _huffman({n: 2.0 ** -abs(n - 4) for n in range(12)})
_AC = _huffman({run << 4 | size: max(0.83 * 0.17**run * 2.0 ** -abs(size - 2.6), 1e-4) for run in range(16) for size in range(1, 9)} | {run << 4: max(0.02 * 0.2**run, 1e-4) for run in range(16)})
REFINED = 5  # coefficients 1 to 5 come in two scans
_FIX = _huffman({0: 0.6} | {run << 4 | 1: 0.2 * 0.5**run for run in range(REFINED)})


def _packed(code: np.ndarray, length: np.ndarray, owner: np.ndarray, n: int) -> list[bytes]:
    """Codes of up to 32 bits as the bytes of ``n`` scans: ones to the end of the last, and a zero after each 255.

    ``owner`` is the scan of each code; codes of one scan stand together, scans in order.
    """
    bits = np.bincount(owner, length, n).astype(np.int64)
    size = (bits + 7) // 8
    base = 8 * (np.cumsum(size) - size)
    start = np.cumsum(length) - length + (base - (np.cumsum(bits) - bits))[owner]
    spare = 8 * size - bits
    start, length, code = np.concatenate([start, base + bits]), np.concatenate([length, spare]), np.concatenate([code, (1 << spare) - 1])
    at, left = start >> 5, 64 - (start & 31) - length
    words = code << np.minimum(left, 63)  # a code of no bits is 0
    # each word of 32 bits is a sum of codes that share no bit
    many = int(size.sum()) // 4 + 2
    both = np.bincount(at, (words >> 32) & 0xFFFFFFFF, many + 1) + np.bincount(at + 1, words & 0xFFFFFFFF, many + 1)
    data = both.astype(">u4").tobytes()
    return [data[a : a + k].replace(b"\xff", b"\xff\x00") for a, k in zip((base // 8).tolist(), size.tolist(), strict=True)]


def _coded(symbol: np.ndarray, value: np.ndarray, size: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol's code followed by ``size`` bits of ``value``, one's complement where negative."""
    return (table[1][symbol] << size) | np.where(value < 0, value + (1 << size) - 1, value), table[2][symbol] + size


def _ac_scans(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The first scans of a band, a row a block and ``counts`` blocks each: runs and sizes, and ends of band over as many blocks as they hold."""
    n, band = values.shape
    flat = values.ravel()
    at = np.flatnonzero(flat)
    value, block = flat[at], at // band
    run = at.copy()
    run[1:] -= at[:-1] + 1
    run = np.minimum(run, at - block * band)
    size = _SIZE[np.abs(value)]
    code, length = _coded((run & 15) << 4 | size, value, size, _AC)
    order = [4 * at + 1]
    # blocks that end in zeros; the end of band of one counts the empty blocks after it too, up to the end of its scan
    last = np.full(n, -1)
    last[block] = at % band
    edges = np.cumsum(counts)
    follows = np.concatenate([[False], last[:-1] < band - 1])
    follows[edges[:-1]] = False
    starts = np.flatnonzero((last < band - 1) & ~((last < 0) & follows))
    if len(starts):
        full = np.append(np.flatnonzero(last >= 0), n)
        part = np.minimum(full[np.searchsorted(full, starts, "right")], edges[np.searchsorted(edges, starts, "right")]) - starts
        place = 4 * (starts * band + np.maximum(last[starts], 0)) + 2
        while (part > 32767).any():
            more = part > 32767
            part, place = np.concatenate([np.minimum(part, 32767), part[more] - 32767]), np.concatenate([place, place[more]])
        bits = np.frexp(part.astype(np.float64))[1].astype(np.int64) - 1
        own = _coded(bits << 4, part - (1 << bits), bits, _AC)
        code, length = np.concatenate([code, own[0]]), np.concatenate([length, own[1]])
        order.append(place)
    if len(run) and run.max() > 15:  # long runs of zeros come before their coefficient
        zeros = np.repeat(4 * at, run >> 4)
        code, length = np.concatenate([code, np.full(len(zeros), _AC[1][0xF0])]), np.concatenate([length, np.full(len(zeros), _AC[2][0xF0])])
        order.append(zeros)
    order = np.concatenate(order)
    sort = np.argsort(order, kind="stable")
    owner = np.repeat(np.arange(len(counts)), counts)[order[sort] // (4 * band)]
    return _packed(code[sort], length[sort], owner, len(counts))


@lru_cache(maxsize=1)
def _fixes() -> tuple[np.ndarray, np.ndarray]:
    """The bits that refine a block, by its coefficients' states in base 5: none, new, new and negative, known with bit 0 or 1."""
    code, length = np.zeros(5**REFINED, np.int64), np.zeros(5**REFINED, np.int64)
    for i in range(5**REFINED):
        bits, late, run = "", "", 0
        name = lambda s: f"{_FIX[1][s]:0{_FIX[2][s]}b}"
        for k in range(REFINED):
            state = i // 5**k % 5
            if state > 2:
                late += "01"[state - 3]
            elif state:
                bits, late, run = bits + name(run << 4 | 1) + "10"[state - 1] + late, "", 0
            else:
                run += 1
        bits += name(0) + late if run or late else ""
        code[i], length[i] = int(bits or "0", 2), len(bits)
    return code, length


def _refine_scans(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The lowest bits of coefficients of which all others are known."""
    big = np.abs(values)
    state = np.where(big > 1, 3 + (big & 1), np.where(values > 0, 1, np.where(values < 0, 2, 0)))
    code, length = _fixes()
    at = state @ 5 ** np.arange(REFINED)
    return _packed(code[at], length[at], np.repeat(np.arange(len(counts)), counts), len(counts))


@lru_cache(maxsize=512)
def _raster(down: int, across: int) -> np.ndarray:
    """The luma blocks of an image row by row, as numbers of units and of blocks in these."""
    return np.arange(down * across * 4).reshape(down, across, 2, 2).transpose(0, 2, 1, 3).ravel()


def _heading(kind: int, ids: tuple[int, ...], tables: int, first: int, last: int, high: int, low: int) -> bytes:
    return _segment(kind, bytes([len(ids), *(x for i in ids for x in (i, tables)), first, last, high << 4 | low]))


def pack_all(payloads: list[bytes]) -> list[bytes]:
    """Progressive 4:2:0 JPEGs whose quantised coefficients are the bytes of each payload, 64 to a block.

    Frequent bytes become small coefficients, the space 0. Blocks fill units of four luma and two chroma blocks in a
    nearly square image; the count of the payload's blocks stands in a comment. Scans: DC without its lowest bit, luma
    AC 1 to 5 without theirs, luma AC 6 to 63, chroma AC whole, the lowest bits of DC and of luma AC 1 to 5. Each
    file is what it would be alone.
    """
    units = [max(1, -(-len(p) // 384)) for p in payloads]
    across = [math.isqrt(u - 1) + 1 for u in units]
    down = [-(-u // a) for u, a in zip(units, across, strict=True)]
    counts = np.array([a * b for a, b in zip(down, across, strict=True)])
    begin = np.cumsum(counts) - counts
    value = np.zeros(int(counts.sum()) * 384, np.int32)
    for p, at in zip(payloads, (begin * 384).tolist(), strict=True):
        value[at : at + len(p)] = _VALUE[np.frombuffer(p, np.uint8)]
    value = value.reshape(-1, 6, 64)
    luma = value[:, :4].reshape(-1, 64)[np.concatenate([_raster(d, a) + 4 * b for d, a, b in zip(down, across, begin.tolist(), strict=True)])]

    first = value[:, :, 0].astype(np.int64)
    half = first >> 1
    step = np.empty_like(half)
    step[:, :4] = np.diff(half[:, :4].ravel(), prepend=0).reshape(-1, 4)
    step[:, 4:] = np.diff(half[:, 4:], axis=0, prepend=0)
    step[begin, 0], step[begin, 4:] = half[begin, 0], half[begin, 4:]
    step, owner = step.ravel(), np.repeat(np.arange(len(payloads)), 6 * counts)
    size = _SIZE[np.abs(step)]
    low, near, edge = (first & 1).ravel(), luma[:, 1 : REFINED + 1], REFINED + 1
    scans = [
        (_heading(0xDA, (1, 2, 3), 0x00, 0, 0, 0, 1), _packed(*_coded(size, step, size, _DC), owner, len(payloads))),
        (_heading(0xDA, (1,), 0x00, 1, REFINED, 0, 1), _ac_scans(np.sign(near) * (np.abs(near) >> 1), 4 * counts)),
        (_heading(0xDA, (1,), 0x00, edge, 63, 0, 0), _ac_scans(luma[:, edge:], 4 * counts)),
        (_heading(0xDA, (2,), 0x00, 1, 63, 0, 0), _ac_scans(value[:, 4, 1:], counts)),
        (_heading(0xDA, (3,), 0x00, 1, 63, 0, 0), _ac_scans(value[:, 5, 1:], counts)),
        (_heading(0xDA, (1, 2, 3), 0x00, 0, 0, 1, 0), _packed(low, np.ones_like(low), owner, len(payloads))),
        (_heading(0xDA, (1,), 0x01, 1, REFINED, 1, 0), _refine_scans(near, 4 * counts)),
    ]
    quantiser = _segment(0xDB, b"\0" + bytes([8] * 64))
    tables = _segment(0xC4, b"".join(where + counts + symbols for where, ((counts, symbols), _, _) in ((b"\x00", _DC), (b"\x10", _AC), (b"\x11", _FIX))))
    out = []
    for i, (p, d, a) in enumerate(zip(payloads, down, across, strict=True)):
        frame = _segment(0xC2, struct.pack(">BHHB", 8, d * 16, a * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
        coded = [x for heading, datas in scans for x in (heading, datas[i])]
        out.append(b"".join([b"\xff\xd8", _segment(0xFE, b"blocks %d" % (len(p) // 64)), quantiser, frame, tables, *coded, b"\xff\xd9"]))
    return out


def pack(payload: bytes) -> bytes:
    return pack_all([payload])[0]


def unpack(image: Image) -> bytes:
    """The payload that ``pack`` has stored, from the decoded coefficients."""
    n = next(int(c[7:]) for c in image.comments if c.startswith(b"blocks "))
    y, cb, cr = (c.coefficients for c in image.components)
    down, across, _ = cb.shape
    value = np.empty((down, across, 6, 64), np.int32)
    value[:, :, :4] = y.reshape(down, 2, across, 2, 64).transpose(0, 2, 1, 3, 4).reshape(down, across, 4, 64)
    value[:, :, 4], value[:, :, 5] = cb, cr
    value = value.ravel()[: 64 * n]
    return RANKED[np.where(value > 0, 2 * value - 1, -2 * value)].tobytes()


def feature(rgb: np.ndarray) -> str:
    """Size, mean colour in hundredths, and a bit for each of 8 x 8 cells that is brighter than the image."""
    h, w, _ = rgb.shape
    grey = rgb.sum(axis=2, dtype=np.int64)
    rows, columns = np.arange(8) * h // 8, np.arange(8) * w // 8
    cells = np.add.reduceat(np.add.reduceat(grey, rows, axis=0), columns, axis=1)
    count = np.diff([*rows, h])[:, None] * np.diff([*columns, w])[None, :]
    bright = cells * h * w > grey.sum() * count
    mean = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64) * 100 // (h * w)
    return f"{w}x{h} {mean[0]} {mean[1]} {mean[2]} {int(''.join('01'[int(b)] for b in bright.ravel()), 2):016x}"


def tensors(files: DataFrame, id_col: str = "media_id", data_col: str = "media") -> DataFrame:
    """``media_id, width, height, rgb``: each row's progressive JPEG as bytes of a height x width x 3 tensor.

    Null and unreadable files give nulls; repeated rows are decoded one by one; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for data in b["media"]:
                try:
                    rgb = decode(bytes(data)).rgb()
                    rows.append((rgb.shape[1], rgb.shape[0], rgb.tobytes()))
                except (TypeError, ValueError, IndexError, KeyError, struct.error):
                    rows.append((None, None, None))
            out = pd.DataFrame(rows, columns=["width", "height", "rgb"])
            yield pd.DataFrame({"media_id": b["media_id"], "width": out["width"].astype("Int32"), "height": out["height"].astype("Int32"), "rgb": out["rgb"]})

    rows = files.select(F.col(id_col).alias("media_id"), F.col(data_col).alias("media"))
    return rows.mapInPandas(run, f"media_id {rows.schema['media_id'].dataType.simpleString()}, width int, height int, rgb binary")


def stored_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: what its text is when stored as a progressive JPEG and read back.

    ``doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature``. A null text
    counts as empty: 64 zero bytes. Equal texts give equal values. Empty tables give empty results.
    """

    def many(texts: list[str]) -> list[tuple]:
        datas = [t.encode() for t in texts]
        files = pack_all([d + bytes(-len(d) % 64 or 64 * (not d)) for d in datas])
        images = decode_all(files)
        rows = []
        for data, file, image, rgb in zip(datas, files, images, tensors_of(images), strict=True):
            payload = unpack(image)
            rows.append((len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(file), hashlib.sha256(file).hexdigest(), feature(rgb)))
        return rows

    def together(texts: list[str]) -> Iterator[list[str]]:
        part: list[str] = []
        for t in texts:
            part.append(t)
            if len(part) == 64 or sum(map(len, part)) > 1 << 17:
                yield part
                part = []
        if part:
            yield part

    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = pd.DataFrame([row for part in together(b["text"].tolist()) for row in many(part)], columns=names)
            yield pd.concat([b[["doc_id"]].reset_index(drop=True), out], axis=1)

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
