"""Baseline JPEG in numpy: what the image steps need where no image library is installed.

Read: 8-bit sequential Huffman files of one or three components, any subsampling, restart marks. Progressive and
arithmetic files raise. Written: one or three components without subsampling, Huffman tables made for the picture.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

#: The standard's quantisation tables, in rows.
LUMA = (
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
)
CHROMA = (17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99, *[99] * 32)
#: The diagonal order of the 64 places of a block, by rule: along diagonals, turning at each.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
_k = np.arange(8)
#: Rows are the cosines of the 8-point transform, orthonormal.
COSINES = np.where(_k[:, None] == 0, np.sqrt(1 / 8), 0.5) * np.cos((2 * _k[None, :] + 1) * _k[:, None] * np.pi / 16)


class _Bits:
    """Bits of a scan's segment, stuffing removed; past the end come ones."""

    def __init__(self, data: bytes):
        self.data, self.at, self.held, self.n = data.replace(b"\xff\x00", b"\xff"), 0, 0, 0

    def need(self, n: int) -> None:
        while self.n < n:
            part = self.data[self.at : self.at + 8].ljust(8, b"\xff")
            self.at += 8
            self.held = (self.held & ((1 << self.n) - 1)) << 64 | int.from_bytes(part)
            self.n += 64

    def take(self, n: int) -> int:
        self.need(n)
        self.n -= n
        return self.held >> self.n & ((1 << n) - 1)

    def symbol(self, table: dict[int, tuple[int, int]]) -> int:
        self.need(16)
        value, size = table[self.held >> (self.n - 16) & 0xFFFF]
        self.n -= size
        return value

    def signed(self, size: int) -> int:
        if not size:
            return 0
        v = self.take(size)
        return v if v >> (size - 1) else v - (1 << size) + 1


def _lookup(counts: bytes, values: bytes) -> dict[int, tuple[int, int]]:
    out, code, at = {}, 0, 0
    for size in range(1, 17):
        for _ in range(counts[size - 1]):
            first = code << (16 - size)
            out.update(dict.fromkeys(range(first, first + (1 << (16 - size))), (values[at], size)))
            code, at = code + 1, at + 1
        code <<= 1
    return out


def decode_jpeg(data: bytes) -> np.ndarray:
    """(height, width) or (height, width, 3), 8 bits."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, quant, huff, frame, restart = 2, {}, {}, None, 0
    while at + 4 <= len(data):
        if data[at] != 0xFF or data[at + 1] == 0xFF:
            at += 1
            continue
        mark, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if mark == 0xDB:
            while body:
                wide = body[0] >> 4
                table = np.frombuffer(body[1 : 1 + 64 * (1 + wide)], ">u2" if wide else "u1").astype(np.int64)
                quant[body[0] & 15], body = table, body[1 + 64 * (1 + wide) :]
        elif mark == 0xC4:
            while body:
                n = sum(body[1:17])
                huff[body[0]], body = _lookup(body[1:17], body[17 : 17 + n]), body[17 + n :]
        elif mark in (0xC0, 0xC1):
            depth, height, width, n = struct.unpack(">BHHB", body[:6])
            if depth != 8 or n not in (1, 3):
                raise ValueError("only 8 bits of one or three components")
            frame = (height, width, [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)])
        elif 0xC2 <= mark <= 0xCF and mark not in (0xC8, 0xCC):
            raise ValueError("only baseline")
        elif mark == 0xDD:
            restart = struct.unpack(">H", body[:2])[0]
        elif mark == 0xDA:
            if frame is None:
                raise ValueError("no frame")
            tables = {body[1 + 2 * i]: (huff[body[2 + 2 * i] >> 4], huff[16 | body[2 + 2 * i] & 15]) for i in range(body[0])}
            return _scan(data[at:], frame, tables, quant, restart)
    raise ValueError("no scan")


def _scan(data: bytes, frame, tables, quant, restart: int) -> np.ndarray:
    height, width, parts = frame
    hmax, vmax = max(p[1] for p in parts), max(p[2] for p in parts)
    if len(parts) == 1:
        parts, hmax, vmax = [(parts[0][0], 1, 1, parts[0][3])], 1, 1
    across, down = -(-width // (8 * hmax)), -(-height // (8 * vmax))
    segments, start, i = [], 0, 0
    while (i := data.find(b"\xff", i)) >= 0 and i + 1 < len(data):
        if data[i + 1] == 0:
            i += 2
        elif 0xD0 <= data[i + 1] <= 0xD7:
            segments.append(data[start:i])
            i = start = i + 2
        elif data[i + 1] == 0xFF:
            i += 1
        else:
            break
    segments.append(data[start : i if i >= 0 else len(data)])
    planes = [np.zeros((down * v, across * h, 64), np.int64) for _, h, v, _ in parts]
    bits, last = _Bits(segments[0]), [0] * len(parts)
    for unit in range(across * down):
        if restart and unit and unit % restart == 0:
            k = unit // restart
            bits, last = _Bits(segments[k] if k < len(segments) else b""), [0] * len(parts)
        y, x = divmod(unit, across)
        for c, (name, h, v, _) in enumerate(parts):
            dc, ac = tables[name]
            for b in range(h * v):
                block = planes[c][y * v + b // h, x * h + b % h]
                last[c] += bits.signed(bits.symbol(dc))
                block[0] = last[c]
                k = 1
                while k < 64:
                    s = bits.symbol(ac)
                    if s == 0:
                        break
                    k += s >> 4
                    if s & 15:
                        if k > 63:
                            raise ValueError("broken block")
                        block[k] = bits.signed(s & 15)
                    k += 1
    out = []
    for plane, (_, h, v, q) in zip(planes, parts, strict=True):
        flat = np.zeros((*plane.shape[:2], 64))
        flat[..., ZIGZAG] = plane * quant[q]
        px = np.einsum("ki,abkl,lj->abij", COSINES, flat.reshape(*plane.shape[:2], 8, 8), COSINES)
        px = px.transpose(0, 2, 1, 3).reshape(plane.shape[0] * 8, plane.shape[1] * 8) + 128
        out.append(px.repeat(vmax // v, 0).repeat(hmax // h, 1)[:height, :width])
    if len(out) == 1:
        return np.clip(np.rint(out[0]), 0, 255).astype(np.uint8)
    y, cb, cr = out[0], out[1] - 128, out[2] - 128
    return np.clip(np.rint(np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], -1)), 0, 255).astype(np.uint8)


def _codes(symbols: list[int]) -> tuple[bytes, bytes, dict[int, tuple[int, int]]]:
    """A Huffman table for the symbols: counts by size, values, and each symbol's (code, size); no code is all ones."""
    freq: dict[int, int] = {-1: 1}
    for s in symbols:
        freq[s] = freq.get(s, 0) + 2
    while True:
        heap = [(n, -s, (s,)) for s, n in freq.items()]
        heapq.heapify(heap)
        size = dict.fromkeys(freq, 0)
        while len(heap) > 1:
            (n, a, x), (m, b, y) = heapq.heappop(heap), heapq.heappop(heap)
            for s in (*x, *y):
                size[s] += 1
            heapq.heappush(heap, (n + m, max(a, b), x + y))
        if max(size.values()) <= 16:
            break
        freq = {s: n // 2 + 1 for s, n in freq.items()}
    order = sorted((s for s in freq if s >= 0), key=lambda s: (size[s], s))
    longest = max(size.values())
    size[-1] = longest  # the place that stays free is the last of the longest codes
    counts, codes, code, last = [0] * 16, {}, 0, 0
    for s in order:
        code <<= size[s] - last
        last = size[s]
        codes[s] = (code, size[s])
        counts[size[s] - 1] += 1
        code += 1
    return bytes(counts), bytes(order), codes


def encode_jpeg(px: np.ndarray, quality: int = 85) -> bytes:
    """px is (height, width) or (height, width, 3), 8 bits."""
    height, width = px.shape[:2]
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    table = lambda t: np.clip((np.array(t) * scale + 50) // 100, 1, 255)
    a = px.astype(float)
    if px.ndim == 2:
        planes = [a]
    else:
        r, g, b = a[..., 0], a[..., 1], a[..., 2]
        planes = [0.299 * r + 0.587 * g + 0.114 * b, 128 - 0.168736 * r - 0.331264 * g + 0.5 * b, 128 + 0.5 * r - 0.418688 * g - 0.081312 * b]
    quant = [table(LUMA), table(CHROMA)]
    blocks = []
    for i, p in enumerate(planes):
        p = np.pad(p, ((0, -height % 8), (0, -width % 8)), "edge") - 128
        p = p.reshape(p.shape[0] // 8, 8, p.shape[1] // 8, 8).transpose(0, 2, 1, 3)
        f = np.einsum("ki,abij,lj->abkl", COSINES, p, COSINES).reshape(*p.shape[:2], 64)
        blocks.append(np.rint(f / quant[min(i, 1)])[..., ZIGZAG].astype(np.int64).reshape(-1, 64))
    pieces: list[tuple[int, int, int, int]] = []  # (table, symbol, bits, number of bits)
    last = [0] * len(blocks)

    def put(table_: int, run: int, v: int) -> None:
        n = abs(v).bit_length()
        pieces.append((table_, run << 4 | n, v if v >= 0 else v + (1 << n) - 1, n))

    for k in range(len(blocks[0])):
        for c, plane in enumerate(blocks):
            row = plane[k]
            put(2 * min(c, 1), 0, int(row[0]) - last[c])
            last[c], at = int(row[0]), 0
            for j in np.flatnonzero(row[1:]).tolist():
                run, at = j - at, j + 1
                while run > 15:
                    pieces.append((2 * min(c, 1) + 1, 0xF0, 0, 0))
                    run -= 16
                put(2 * min(c, 1) + 1, run, int(row[j + 1]))
            if at < 63:
                pieces.append((2 * min(c, 1) + 1, 0, 0, 0))
    some = range(4 if len(blocks) > 1 else 2)
    huff = [_codes([s for t, s, _, _ in pieces if t == i]) for i in some]
    bits = "".join(f"{code:0{size}b}" + (f"{v:0{n}b}" if n else "") for t, s, v, n in pieces for code, size in (huff[t][2][s],))
    bits += "1" * (-len(bits) % 8)
    body = int(bits, 2).to_bytes(len(bits) // 8).replace(b"\xff", b"\xff\x00")
    part = lambda mark, data: struct.pack(">BBH", 0xFF, mark, len(data) + 2) + data
    out = b"\xff\xd8" + part(0xE0, b"JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00")
    for i, q in enumerate(quant[: len(blocks)][:2]):
        out += part(0xDB, bytes([i]) + bytes(q[ZIGZAG].tolist()))
    n = len(blocks)
    out += part(0xC0, struct.pack(">BHHB", 8, height, width, n) + b"".join(bytes([c + 1, 0x11, min(c, 1)]) for c in range(n)))
    for i in some:
        out += part(0xC4, bytes([(i % 2) << 4 | i // 2]) + huff[i][0] + huff[i][1])
    out += part(0xDA, bytes([n]) + b"".join(bytes([c + 1, min(c, 1) * 0x11]) for c in range(n)) + b"\x00\x3f\x00")
    return out + body + b"\xff\xd9"
