"""Adaptive context-mixing range coder for token ids.

Ids are coded in blocks that start from nothing and carry a checksum each. In a block, order 2
and order 1 each predict the id that last followed the same two ids, or the same one; order 0
predicts every id by its share of the file. The three are mixed into one distribution,

    P(id) = w2 [id = second-order guess] + w1 [id = first-order guess] + w0 share(id),

whose weights adapt to how often each order was right before at the same confidence, and the
id's interval of it drives a carry-less range coder with 16-bit words. All numbers are integers,
so both sides compute the same. A file starts with its documents and its alphabet with shares.

The blocks of a file are independent, so many of them are coded at once, one array element per
block, step by step.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDCM1\n"
BLOCK_IDS = 4096
LANES = 1024
GUESSES = 1 << 12
ONE = 12  # bits of the mixing weights
RATE = 5
_U = np.uint64
_FLOOR = _U(1 << 40)
_TOP = _U(1 << 48)
_ALL = _U((1 << 64) - 1)
_16, _48 = _U(16), _U(48)


class _Shares:
    """Order 0: integer shares of the file's ids that sum to a power of two, at least 1 each."""

    def __init__(self, counts: np.ndarray):
        bits = max(14, int(4 * len(counts) - 1).bit_length())
        self.bits = bits
        spare = (1 << bits) - len(counts)
        share = 1 + (counts * spare // max(1, int(counts.sum())))
        share[int(np.argmax(counts))] += (1 << bits) - int(share.sum())
        self.size = share.astype(np.int32)
        self.below = (np.cumsum(share) - share).astype(np.int32)
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.int32), share)


class _Mixer:
    """The adaptive state of so many blocks at once."""

    def __init__(self, lanes: int, alphabet: int):
        kind = np.uint16 if alphabet < 1 << 14 else np.uint32
        self.kind = kind
        self.table1, self.table2 = np.zeros(lanes * GUESSES, kind), np.zeros(lanes * GUESSES, kind)
        self.gate2 = np.full(lanes * 32, 1 << ONE - 2, np.int32)
        self.gate1 = np.full(lanes * 32, 1 << ONE - 2, np.int32)
        self.home = np.arange(lanes) * GUESSES
        self.node0 = np.arange(lanes) * 32
        self.one = np.zeros(lanes, np.int64)
        self.two = np.zeros(lanes, np.int64)

    def look(self, m: int) -> None:
        """Guesses and weights of the first m blocks."""
        one = self.one[:m]
        self.at1 = self.home[:m] + (one & GUESSES - 1)
        self.at2 = self.home[:m] + ((one * 40503 + self.two[:m] * 30011 >> 4) & GUESSES - 1)
        e1, e2 = self.table1[self.at1].astype(np.int32), self.table2[self.at2].astype(np.int32)
        self.guess1, self.guess2 = e1 >> 2, e2 >> 2
        self.sure1, self.sure2 = e1 & 3, e2 & 3
        self.node = self.node0[:m] + (self.sure2 << 3) + (self.sure1 << 1) + (self.guess1 == self.guess2)
        self.p2, self.p1 = self.gate2[self.node], self.gate1[self.node]
        self.w2 = self.p2
        self.w1 = np.maximum(((1 << ONE) - self.p2) * self.p1 >> ONE, 1)
        self.edge = self.w2 + self.w1
        self.w0 = (1 << ONE) - self.edge

    def learn(self, m: int, symbol: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """hit2, hit1: whether the second-order, or else the first-order guess coded the id."""
        self.gate2[self.node] = np.maximum(self.p2 + ((hit2.astype(np.int32) << ONE) - self.p2 >> RATE), 16)
        moved = np.maximum(self.p1 + ((hit1.astype(np.int32) << ONE) - self.p1 >> RATE), 16)
        self.gate1[self.node] = np.where(hit2, self.p1, moved)
        fresh = (symbol << 2) + 1
        e1 = (self.guess1 << 2) + np.minimum(self.sure1 + 1, 3)
        e2 = (self.guess2 << 2) + np.minimum(self.sure2 + 1, 3)
        self.table1[self.at1] = np.where((self.guess1 == symbol) & (self.sure1 > 0), e1, fresh)
        self.table2[self.at2] = np.where((self.guess2 == symbol) & (self.sure2 > 0), e2, fresh)
        self.two[:m] = self.one[:m]
        self.one[:m] = symbol


def _settled(low: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Blocks whose first word is fixed; a span too narrow is cut at the next border, which fixes it."""
    fixed = (low ^ (low + span)) < _TOP
    narrow = span < _FLOOR
    if narrow.any():
        narrow &= ~fixed
        span[narrow] = (~low[narrow] + _U(1)) & (_FLOOR - _U(1))
        fixed |= narrow
    return np.flatnonzero(fixed)


def _sizes(n: int, block: int) -> np.ndarray:
    """Sizes of the blocks of n ids: equal but for one, longer ones first."""
    k = -(-n // block)
    return np.full(k, n // k) + (np.arange(k) < n % k) if k else np.zeros(0, np.int64)


def _live(sizes: np.ndarray, t: int) -> int:
    return len(sizes) if t < sizes[-1] else int((sizes > t).sum())


def _encode(ids: np.ndarray, sizes: np.ndarray, shares: _Shares) -> list[bytes]:
    lanes, most = len(sizes), int(sizes[0])
    mixer = _Mixer(lanes, len(shares.size))
    first = np.cumsum(sizes) - sizes
    low, span = np.zeros(lanes, _U), np.full(lanes, _ALL)
    words, used, width = np.zeros(lanes * (3 * most + 8), np.uint16), np.zeros(lanes, np.int64), 3 * most + 8
    home, bits = np.arange(lanes) * width, shares.bits
    for t in range(most):
        m = _live(sizes, t)
        symbol = ids[first[:m] + t]
        mixer.look(m)
        hit2 = (mixer.guess2 == symbol) & (mixer.sure2 > 0)
        hit1 = (mixer.guess1 == symbol) & (mixer.sure1 > 0) & ~hit2
        hit = hit1 | hit2
        under = np.where(hit, np.where(hit2, 0, mixer.w2) << bits, (mixer.edge << bits) + mixer.w0 * shares.below[symbol])
        size = np.where(hit, np.where(hit2, mixer.w2, mixer.w1) << bits, mixer.w0 * shares.size[symbol])
        part = span[:m] >> _U(ONE + bits)
        low[:m] += part * under.astype(_U)
        np.multiply(part, size.astype(_U), out=span[:m])
        mixer.learn(m, symbol, hit2, hit1)
        out = _settled(low[:m], span[:m])
        while len(out):
            lo, sp = low[out], span[out]
            words[home[out] + used[out]] = lo >> _48
            used[out] += 1
            lo, sp = lo << _16, sp << _16
            low[out], span[out] = lo, sp
            more = _settled(lo, sp)
            span[out] = sp
            out = out[more]
    for _ in range(4):
        words[home + used] = low >> _48
        low <<= _16
        used += 1
    return [words[a:a + n].astype("<u2").tobytes() for a, n in zip(home.tolist(), used.tolist())]


def _decode(parts: list[bytes], sizes: np.ndarray, shares: _Shares) -> np.ndarray:
    lanes, most = len(sizes), int(sizes[0])
    mixer = _Mixer(lanes, len(shares.size))
    first = np.cumsum(sizes) - sizes
    width = max(map(len, parts)) // 2 + 8
    words = np.zeros((lanes, width), np.uint16)
    for k, part in enumerate(parts):
        words[k, :len(part) // 2] = np.frombuffer(part, "<u2")
    ahead = np.zeros(lanes, _U)  # code less low
    for k in range(4):
        ahead = ahead << _16 | words[:, k].astype(_U)
    words = words.ravel()
    at = np.arange(lanes) * width + 4
    low, span = np.zeros(lanes, _U), np.full(lanes, _ALL)
    ids = np.empty(int(sizes.sum()), np.int32)
    bits = shares.bits
    for t in range(most):
        m = _live(sizes, t)
        mixer.look(m)
        part = span[:m] >> _U(ONE + bits)
        value = (ahead[:m] // part).astype(np.int32)
        over = value - (mixer.edge << bits)
        hit = over < 0
        hit2 = hit & (value < mixer.w2 << bits)
        hit1 = hit & ~hit2
        inner = (np.maximum(over, 0) / mixer.w0).astype(np.int32)
        symbol = shares.symbol[np.minimum(inner, len(shares.symbol) - 1)]
        under = np.where(hit, np.where(hit2, 0, mixer.w2) << bits, (mixer.edge << bits) + mixer.w0 * shares.below[symbol])
        size = np.where(hit, np.where(hit2, mixer.w2, mixer.w1) << bits, mixer.w0 * shares.size[symbol])
        symbol = np.where(hit, np.where(hit2, mixer.guess2, mixer.guess1), symbol)
        ids[first[:m] + t] = symbol
        step = part * under.astype(_U)
        low[:m] += step
        ahead[:m] -= step
        np.multiply(part, size.astype(_U), out=span[:m])
        mixer.learn(m, symbol, hit2, hit1)
        out = _settled(low[:m], span[:m])
        while len(out):
            lo, sp = low[out] << _16, span[out] << _16
            low[out] = lo
            ahead[out] = ahead[out] << _16 | words[at[out]].astype(_U)
            at[out] += 1
            more = _settled(lo, sp)
            span[out] = sp
            out = out[more]
    return ids


def _pack(data: bytes) -> bytes:
    small = zlib.compress(data)
    return struct.pack("<II", len(small), zlib.crc32(small)) + small


def _unpack(data: bytes, at: int) -> tuple[bytes, int]:
    size, check = struct.unpack_from("<II", data, at)
    small = data[at + 8:at + 8 + size]
    if zlib.crc32(small) != check:
        raise ValueError("damaged section")
    return zlib.decompress(small), at + 8 + size


def write_ids(ids: np.ndarray, rows: bytes, block: int = BLOCK_IDS) -> bytes:
    """A file's bytes: magic, `rows` (any description of its documents), alphabet, checksummed blocks."""
    counts = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
    for a in range(0, len(ids), 1 << 20):
        counts += np.bincount(ids[a:a + (1 << 20)], minlength=len(counts))
    alphabet = np.flatnonzero(counts)
    rank = np.zeros(len(counts), np.int32)
    rank[alphabet] = np.arange(len(alphabet))
    sizes = _sizes(len(ids), block)
    out = [MAGIC, _pack(rows), _pack(alphabet.astype("<u4").tobytes()), _pack(counts[alphabet].astype("<u8").tobytes()),
           struct.pack("<QI", len(ids), len(sizes))]
    if len(ids):
        shares, ends = _Shares(counts[alphabet]), np.cumsum(sizes)
        for a in range(0, len(sizes), LANES):
            own = sizes[a:a + LANES]
            part = rank[ids[int(ends[a] - sizes[a]):int(ends[a + len(own) - 1])]]
            for size, data in zip(own.tolist(), _encode(part, own, shares)):
                out += [struct.pack("<III", size, len(data), zlib.crc32(data)), data]
    return b"".join(out)


def read_ids(data: bytes) -> tuple[np.ndarray, bytes]:
    """(ids, rows) of a file's bytes; a damaged block or section raises ValueError."""
    if data[:len(MAGIC)] != MAGIC:
        raise ValueError("not a file of ids")
    rows, at = _unpack(data, len(MAGIC))
    alphabet, at = _unpack(data, at)
    counts, at = _unpack(data, at)
    alphabet = np.frombuffer(alphabet, "<u4").astype(np.int64)
    n, blocks = struct.unpack_from("<QI", data, at)
    at += 12
    shares = _Shares(np.frombuffer(counts, "<u8").astype(np.int64)) if n else None
    sizes, parts, out = [], [], []
    for k in range(blocks):
        size, length, check = struct.unpack_from("<III", data, at)
        part = data[at + 12:at + 12 + length]
        if len(part) != length or zlib.crc32(part) != check:
            raise ValueError(f"damaged block {k}")
        sizes.append(size)
        parts.append(part)
        at += 12 + length
        if len(sizes) == LANES or k == blocks - 1:
            out.append(alphabet[_decode(parts, np.array(sizes), shares)])
            sizes, parts = [], []
    ids = np.concatenate(out) if out else np.zeros(0, np.int64)
    if len(ids) != n:
        raise ValueError("ids are missing")
    return ids, rows
