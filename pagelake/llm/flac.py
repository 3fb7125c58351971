"""FLAC in numpy: many streams at once, every frame of them in lockstep.

The writer makes mono streams with a seek point for every frame, so the reader knows where all frames start and can
decode them side by side: step i reads the i-th Rice code of every frame. Streams without seek points are read one
frame after the other by the same code. Checksums of headers and frames, and the MD5 of the samples, are verified.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass, field

import numpy as np

BLOCK, RATE, LPC_ORDER, LPC_BITS = 4_096, 8_000, 4, 12
#: Rice partitions of a frame are a quarter of it.
PARTITION_ORDER = 2
#: Samples (the longest frame's, times frames) that are decoded side by side, at most (at least one frame).
CELLS = 3_000_000


class Damaged(ValueError):
    """A checksum does not fit, or the stream is not FLAC."""


# ------------------------------------------------------------------ checksums


@functools.lru_cache
def _table(poly: int, bits: int) -> np.ndarray:
    top, mask = 1 << bits - 1, (1 << bits) - 1
    out = []
    for b in range(256):
        crc = b << bits - 8
        for _ in range(8):
            crc = (crc << 1 ^ poly if crc & top else crc << 1) & mask
        out.append(crc)
    return np.array(out, np.uint16)


def crc8(data: bytes) -> int:
    crc, table = 0, _table(0x07, 8)
    for b in data:
        crc = int(table[crc ^ b])
    return crc


@functools.lru_cache
def _by_distance(size: int) -> np.ndarray:
    """CRC-16 of one byte that `row` zero bytes follow."""
    table = _table(0x8005, 16)
    out = np.empty((size, 256), np.uint16)
    out[0] = table
    for d in range(1, size):
        out[d] = out[d - 1] << np.uint16(8) ^ table[out[d - 1] >> np.uint16(8)]
    return out


def crc16(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each stretch of a buffer: the checksum is linear, so every byte adds its own share."""
    if not len(starts):
        return np.zeros(0, np.uint16)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    k = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    table = _by_distance(1 << int(sizes.max() - 1).bit_length() if sizes.max() > 1 else 1)
    shares = table[np.repeat(sizes, sizes) - 1 - k, buffer[np.repeat(starts, sizes) + k]]
    return np.bitwise_xor.reduceat(shares, first)


# ------------------------------------------------------------------ writing


def _number(n: int) -> bytes:
    """A frame's number in the extended UTF-8 of frame headers."""
    if n < 0x80:
        return bytes([n])
    more = 1
    while n >= 1 << (6 - more) + 6 * more:
        more += 1
    return bytes([(0xFF << 7 - more) & 0xFF | n >> 6 * more, *(0x80 | n >> 6 * k & 0x3F for k in range(more - 1, -1, -1))])


@functools.lru_cache(maxsize=1 << 14)
def _header(number: int, size: int) -> bytes:
    head = b"\xff\xf8\x74\x02" + _number(number) + (size - 1).to_bytes(2, "big")  # 16-bit size, 8 kHz, mono, 8 bits
    return head + bytes([crc8(head)])


def _levinson(auto: np.ndarray) -> np.ndarray:
    """Predictor coefficients of each row of autocorrelations, element by element, so rows do not see each other."""
    n, order = auto.shape[0], auto.shape[1] - 1
    a, err = np.zeros((n, order)), auto[:, 0] * (1 + 1e-9) + 1e-9
    for i in range(order):
        acc = auto[:, i + 1].copy()
        for j in range(i):
            acc -= a[:, j] * auto[:, i - j]
        k = acc / err
        new = a.copy()
        new[:, i] = k
        for j in range(i):
            new[:, j] = a[:, j] - k * a[:, i - 1 - j]
        a, err = new, np.maximum(err * (1 - k * k), 1e-9)
    return a


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream of 8-bit mono samples (byte minus 128) for every payload; lengths are positive multiples of 64."""
    if not payloads:
        return []
    raw = np.frombuffer(b"".join(payloads), np.uint8)
    x = raw.astype(np.int16) - np.int16(128)
    sizes, numbers, owner = [], [], []
    for k, p in enumerate(payloads):
        whole, rest = divmod(len(p), BLOCK)
        mine = [BLOCK] * whole + [rest] * (rest > 0)
        sizes += mine
        numbers += range(len(mine))
        owner += [k] * len(mine)
    size = np.array(sizes, np.int64)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    frames = len(size)
    # residuals of the fixed predictors and of a linear one; first samples of a frame are stored as they are
    auto = np.empty((frames, LPC_ORDER + 1))
    for lag in range(LPC_ORDER + 1):
        product = np.zeros(len(x), np.int16)
        np.multiply(x[lag:], x[: len(x) - lag], out=product[lag:])  # at most 2 ** 14
        for j in range(lag):
            product[start + j] = 0
        auto[:, lag] = np.add.reduceat(product, start, dtype=np.int64)
    real = _levinson(auto)
    most = np.abs(real).max(axis=1)
    shift = np.clip(LPC_BITS - 1 - np.ceil(np.log2(np.maximum(most, 1e-6) * (1 + 1e-9))).astype(np.int64), 0, 14)
    coefs = np.clip(np.rint(real * (1 << shift)[:, None]), -(1 << LPC_BITS - 1), (1 << LPC_BITS - 1) - 1).astype(np.int64)
    of = np.repeat(np.arange(frames), size)
    guess = np.zeros(len(x), np.int32)
    for j in range(LPC_ORDER):
        guess[j + 1 :] += np.repeat(coefs[:, j].astype(np.int32), size)[j + 1 :] * x[: len(x) - j - 1]
    linear = x - (guess >> np.repeat(shift.astype(np.int32), size))
    for j in range(LPC_ORDER):
        linear[start + j] = 0
    choices = [x]
    for _ in range(4):
        d = np.zeros_like(x)
        np.subtract(choices[-1][1:], choices[-1][:-1], out=d[1:])
        choices.append(d)
    for o in range(4, 0, -1):
        for j in range(o):
            choices[o][start + j] = 0
    choices.append(linear)
    cost = np.stack([np.add.reduceat(np.abs(d), start, dtype=np.int64) for d in choices])
    cost[5] += 2 * (LPC_ORDER * LPC_BITS + 9)
    best = np.argmin(cost, axis=0)
    order = np.where(best == 5, LPC_ORDER, best)
    r = np.zeros(len(x), np.int32)
    which = np.repeat(best.astype(np.int8), size)
    for c, d in enumerate(choices):
        np.copyto(r, d, where=which == c)
    u = r << 1 ^ r >> 31
    # Rice parameters by partition
    parts = 1 << PARTITION_ORDER
    plen = np.repeat(size >> PARTITION_ORDER, parts)
    pstart = np.concatenate([[0], np.cumsum(plen)[:-1]])
    total = np.add.reduceat(u, pstart, dtype=np.int64)
    k = np.clip(np.ceil(np.log2(np.maximum(total / plen * 0.6931, 1e-9))), 0, 14).astype(np.int64)
    ks = np.repeat(k.astype(np.int32), plen)
    within = np.arange(len(x)) - np.repeat(start, size)
    stored = np.zeros(len(x), bool)
    for j in range(LPC_ORDER):
        stored[start[order > j] + j] = True
    bits = (u >> ks) + 1 + ks
    bits[stored] = 0
    bits[pstart] += 4  # each partition opens with its parameter
    bits_of = np.add.reduceat(bits, start, dtype=np.int64)
    coded = 8 + 8 * order + np.where(best == 5, 9 + LPC_ORDER * LPC_BITS, 0) + 6 + bits_of
    constant = np.maximum.reduceat(x, start) == np.minimum.reduceat(x, start)
    verbatim = ~constant & (coded >= 8 + 8 * size)
    body = np.where(constant, 16, np.where(verbatim, 8 + 8 * size, coded))
    heads = [_header(n, s) for n, s in zip(numbers, sizes, strict=True)]
    head_len = np.array([len(h) for h in heads], np.int64)
    frame_len = head_len + (body + 7 >> 3) + 2
    at = np.concatenate([[0], np.cumsum(frame_len)[:-1]])
    lanes = np.zeros((int(frame_len.sum()) + 1 >> 1) + 2)

    def put(pos: np.ndarray, value: np.ndarray, width: np.ndarray | int) -> None:
        """Fields of up to 16 bits, added to 16-bit lanes; they do not overlap, so sums are unions."""
        lane, off = pos >> 4, pos & 15
        wide = value.astype(np.int64) << (32 - off - width)
        lanes[:] += np.bincount(lane, wide >> 16, len(lanes))
        lanes[:] += np.bincount(lane + 1, wide & 0xFFFF, len(lanes))

    sub = 8 * (at + head_len)  # bit where the subframe starts
    kind = np.where(constant, 0, np.where(verbatim, 1, np.where(best == 5, 32 + LPC_ORDER - 1, 8 + best)))
    put(sub, kind << 1, 8)
    at8 = sub + 8
    put(at8[constant], raw[start[constant]] ^ 0x80, 8)  # signed 8 bits
    plain = np.flatnonzero(np.repeat(verbatim, size))
    put(at8[of[plain]] + 8 * within[plain], raw[plain] ^ 0x80, 8)
    rice = ~constant & ~verbatim
    warm = np.flatnonzero(stored & np.repeat(rice, size))
    put(at8[of[warm]] + 8 * within[warm], raw[warm] ^ 0x80, 8)
    after = at8 + 8 * order
    lin = np.flatnonzero(rice & (best == 5))
    put(after[lin], np.full(len(lin), LPC_BITS - 1), 4)
    put(after[lin] + 4, shift[lin], 5)
    for j in range(LPC_ORDER):
        put(after[lin] + 9 + LPC_BITS * j, coefs[lin, j] & (1 << LPC_BITS) - 1, LPC_BITS)
    after = after + np.where(best == 5, 9 + LPC_ORDER * LPC_BITS, 0)
    put(after[rice], np.full(int(rice.sum()), PARTITION_ORDER), 6)
    ends = np.cumsum(bits, dtype=np.int64)
    pos = ends - bits + np.repeat(after + 6 - ends[start] + bits[start], size)
    opens = pstart[np.repeat(rice, parts)]
    put(pos[opens], ks[opens], 4)
    pos[pstart] += 4
    code = ~stored & np.repeat(rice, size)
    u, ks, pos = u[code], ks[code], pos[code]
    one = np.int32(1) << ks
    put(pos + (u >> ks), one | u & one - 1, ks + 1)
    out = lanes.astype(">u2").view(np.uint8)[: int(frame_len.sum())].copy()
    heads_flat = np.frombuffer(b"".join(heads), np.uint8)
    out[np.repeat(at, head_len) + np.arange(len(heads_flat)) - np.repeat(np.cumsum(head_len) - head_len, head_len)] = heads_flat
    crc = crc16(out, at, frame_len - 2)
    out[at + frame_len - 2], out[at + frame_len - 1] = crc >> 8, crc & 0xFF
    body_bytes = out.tobytes()
    streams, f = [], 0
    for k_, p in enumerate(payloads):
        g = f
        while g < frames and owner[g] == k_:
            g += 1
        lens = frame_len[f:g]
        info = BLOCK.to_bytes(2, "big") * 2 + int(lens.min()).to_bytes(3, "big") + int(lens.max()).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big") + hashlib.md5(x[start[f] : start[f] + len(p)].astype(np.int8).tobytes()).digest()
        points = np.zeros(g - f, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")]))
        points["sample"], points["offset"], points["n"] = start[f:g] - start[f], at[f:g] - at[f], size[f:g]
        seek = points.tobytes()
        end = int(at[g - 1] + frame_len[g - 1])
        streams.append(b"fLaC\x00\x00\x00\x22" + info + b"\x83" + len(seek).to_bytes(3, "big") + seek + body_bytes[at[f] : end])
        f = g
    return streams


# ------------------------------------------------------------------ reading


@dataclass
class Stream:
    """What the metadata say, and where frames start."""

    data: bytes
    rate: int
    channels: int
    bits: int
    total: int
    md5: bytes
    first: int
    seek: list[tuple[int, int, int]] = field(default_factory=list)


def open_stream(data: bytes) -> Stream:
    if data[:4] != b"fLaC":
        raise Damaged("no fLaC mark")
    at, out = 4, None
    seek: list[tuple[int, int, int]] = []
    while True:
        last, kind, n = data[at] >> 7, data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
        block = data[at + 4 : at + 4 + n]
        if kind == 0:
            v = int.from_bytes(block[10:18], "big")
            out = Stream(data, v >> 44, (v >> 41 & 7) + 1, (v >> 36 & 31) + 1, v & (1 << 36) - 1, block[18:34], 0)
        elif kind == 3:
            seek = [(int.from_bytes(block[i : i + 8], "big"), int.from_bytes(block[i + 8 : i + 16], "big"), int.from_bytes(block[i + 16 : i + 18], "big")) for i in range(0, n - 17, 18)]
        at += 4 + n
        if last:
            break
    if out is None:
        raise Damaged("no stream information")
    out.first = at
    out.seek = [p for p in seek if p[0] != (1 << 64) - 1]
    return out


def _frame_head(data: bytes, at: int, info: Stream) -> tuple[int, int, int, int]:
    """(samples, channel assignment, bits a sample, header bytes) of the frame at a byte."""
    b = data[at : at + 17]
    if len(b) < 6 or b[0] != 0xFF or b[1] & 0xFE != 0xF8:
        raise Damaged("no frame where one should start")
    more = 0
    while b[4] & 0x80 >> more and more < 7:
        more += 1
    n = 4 + max(1, more)
    code, rate = b[2] >> 4, b[2] & 15
    if code == 6:
        samples, n = b[n] + 1, n + 1
    elif code == 7:
        samples, n = int.from_bytes(b[n : n + 2], "big") + 1, n + 2
    elif code == 1:
        samples = 192
    else:
        samples = 576 << code - 2 if code < 6 else 256 << code - 8
    n += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if crc8(b[:n]) != b[n]:
        raise Damaged("header checksum")
    bits = {0: info.bits, 1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}[b[3] >> 1 & 7]
    return samples, b[3] >> 4, bits, n + 1


class _Bits:
    """Random access to the bits of a buffer, for many positions at once."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data + bytes(16), np.uint8)
        n = len(data) + 8
        self.words = np.zeros(n, np.uint64)
        for k in range(8):
            self.words |= raw[k : k + n].astype(np.uint64) << np.uint64(56 - 8 * k)

    def peek(self, pos: np.ndarray) -> np.ndarray:
        """57 bits or more from each position, at the top of a word."""
        return self.words[pos >> 3] << (pos & 7).astype(np.uint64)

    def read(self, pos: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        width = np.broadcast_to(np.asarray(width, np.uint64), pos.shape)
        got = self.peek(pos) >> np.uint64(1) >> (np.uint64(63) - width)  # width 0 gives 0
        return got.astype(np.int64)

    def signed(self, pos: np.ndarray, width: np.ndarray) -> np.ndarray:
        v = self.read(pos, width)
        width = np.broadcast_to(width, pos.shape)
        return v - ((v >> width - 1 & 1) << width)

    def unary(self, pos: np.ndarray) -> np.ndarray:
        """Zeros before the next one-bit."""
        q = np.zeros(len(pos), np.int64)
        todo = np.arange(len(pos))
        at = pos.copy()
        while len(todo):
            top = self.peek(at[todo]) >> np.uint64(11)
            zeros = 52 - ((top.astype(np.float64).view(np.int64) >> 52) - 1023)
            none = top == 0
            q[todo] += np.where(none, 53, zeros)
            at[todo] += 53
            todo = todo[none]
            if len(todo) and (at[todo] >> 3).max() >= len(self.words) - 1:
                raise Damaged("a code runs over the end")
        return q


def _rice(bits: _Bits, pos: np.ndarray, order: np.ndarray, samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Residuals (step, frame) after the predictors' first samples, and the bit after each frame's last code."""
    method = bits.read(pos, 2)
    if (method > 1).any():
        raise Damaged("unknown residual coding")
    porder = bits.read(pos + 2, 4)
    pos = pos + 6
    count = samples - order
    rank = np.argsort(-count, kind="stable")
    pos, plen, count, method, order = pos[rank], (samples >> porder)[rank], count[rank], method[rank], order[rank]
    width = 4 + method
    out = np.zeros((int(count[0]) if len(count) else 0, len(pos)), np.int32)
    togo, k, plain = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
    first = plen - order
    escaped = False
    active = np.searchsorted(-count, -np.arange(out.shape[0]), "left")
    for i in range(out.shape[0]):
        n = active[i]
        fresh = np.flatnonzero(togo[:n] == 0)
        while len(fresh):
            k[fresh] = bits.read(pos[fresh], width[fresh])
            pos[fresh] += width[fresh]
            togo[fresh] = first[fresh]
            first[fresh] = plen[fresh]
            raw = k[fresh] == (1 << width[fresh]) - 1
            plain[fresh] = 0
            if raw.any():
                escaped, e = True, fresh[raw]
                plain[e] = 64 + bits.read(pos[e], 5)
                pos[e] += 5
            fresh = fresh[togo[fresh] == 0]  # a first partition may hold no code
        p, kk = pos[:n], k[:n]
        word = bits.peek(p)
        top = word >> np.uint64(11)
        q = 52 - ((top.astype(np.float64).view(np.int64) >> 52) - 1023)
        if not top.all() or (q + kk > 55).any():
            q = np.zeros(n, np.int64)
            coded = np.flatnonzero(plain[:n] == 0)
            q[coded] = bits.unary(p[coded])
            low = bits.read(p + q + 1, kk)
        else:
            low = (word << (q + 1).astype(np.uint64) >> np.uint64(1) >> (63 - kk).astype(np.uint64)).astype(np.int64)
        u = q << kk | low
        value, used = u >> 1 ^ -(u & 1), q + 1 + kk
        if escaped and (raw := plain[:n] > 0).any():
            w = plain[:n] - 64
            v = bits.read(p, np.where(raw, w, 0))
            v = np.where(w > 0, v - ((v >> np.maximum(w - 1, 0) & 1) << np.maximum(w, 0)), 0)
            value, used = np.where(raw, v, value), np.where(raw, w, used)
        out[i, :n] = value
        pos[:n] = p + used
        togo[:n] -= 1
    back = np.empty_like(rank)
    back[rank] = np.arange(len(rank))
    return out[:, back], pos[back]


def _subframes(bits: _Bits, pos: np.ndarray, samples: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Samples (step, frame) of one channel of each frame, and the bit after it."""
    most = int(samples.max())
    out = np.zeros((most, len(pos)), np.int64)
    kind, flag = bits.read(pos + 1, 6), bits.read(pos + 7, 1)
    pos = pos + 8
    wasted = np.zeros(len(pos), np.int64)
    if flag.any():
        w = np.flatnonzero(flag)
        wasted[w] = bits.unary(pos[w]) + 1
        pos[w] += wasted[w]
    depth = depth - wasted
    order = np.where(kind >= 32, kind - 31, np.where(kind >= 8, kind - 8, 0))
    same = np.flatnonzero(kind == 0)
    if len(same):
        out[:, same] = bits.signed(pos[same], depth[same])
        pos[same] += depth[same]
    plain = np.flatnonzero(kind == 1)
    for i in range(int(samples[plain].max()) if len(plain) else 0):
        here = plain[samples[plain] > i]
        out[i, here] = bits.signed(pos[here], depth[here])
        pos[here] += depth[here]
    coded = np.flatnonzero(kind >= 8)
    if len(coded):
        for i in range(int(order[coded].max())):
            here = coded[order[coded] > i]
            out[i, here] = bits.signed(pos[here], depth[here])
            pos[here] += depth[here]
        linear = coded[kind[coded] >= 32]
        shift, coefs = np.zeros(len(pos), np.int64), np.zeros((32, len(pos)), np.int64)
        if len(linear):
            precision = bits.read(pos[linear], 4) + 1
            shift[linear] = bits.read(pos[linear] + 4, 5)
            pos[linear] += 9
            for j in range(int(order[linear].max())):
                has = order[linear] > j
                here = linear[has]
                coefs[j, here] = bits.signed(pos[here], precision[has])
                pos[here] += precision[has]
        res, pos[coded] = _rice(bits, pos[coded], order[coded], samples[coded])
        for o in range(5):
            mine = np.flatnonzero((kind[coded] < 32) & (order[coded] == o))
            if not len(mine):
                continue
            d, here = res[: most - o, mine].astype(np.int64), coded[mine]
            warm = [out[:o, here]]
            for _ in range(o):
                warm.append(np.diff(warm[-1], axis=0))
            for j in range(o - 1, -1, -1):
                d = np.cumsum(d, axis=0) + warm[j][-1]
            out[o : o + len(d), here] = d
        for o in np.unique(order[linear]):
            here = linear[order[linear] == o]
            r = res[:, np.searchsorted(coded, here)]
            c, s = coefs[:o, here], shift[here]
            x = out[:, here]
            for i in range(int(o), int(samples[here].max())):
                guess = c[0] * x[i - 1]
                for j in range(1, int(o)):
                    guess += c[j] * x[i - 1 - j]
                x[i] = r[i - o] + (guess >> s)
            out[:, here] = x
    return out << wasted, pos


def decode_frames(data: bytes, starts: list[int], info: Stream, ends: list[int] | None = None) -> tuple[list[np.ndarray], list[int]]:
    """Samples (n, channels) of each frame of a buffer, and the byte after it. Checks both checksums."""
    heads = [_frame_head(data, at, info) for at in starts]
    bits = _Bits(data)
    samples = np.array([h[0] for h in heads], np.int64)
    assign, depth = np.array([h[1] for h in heads]), np.array([h[2] for h in heads], np.int64)
    pos = 8 * np.array([at + h[3] for at, h in zip(starts, heads, strict=True)], np.int64)
    channels = np.where(assign < 8, assign + 1, 2)
    got = []
    for c in range(int(channels.max())):
        here = np.flatnonzero(channels > c)
        wide = depth + (((assign == 8) & (c == 1)) | ((assign == 9) & (c == 0)) | ((assign == 10) & (c == 1)))
        values, pos[here] = _subframes(bits, pos[here], samples[here], wide[here])
        full = np.zeros((values.shape[0] if c == 0 else got[0].shape[0], len(heads)), np.int64)
        full[: values.shape[0], here] = values
        got.append(full)
    if len(got) > 1:
        a, b = got[0], got[1]
        left, right = a.copy(), b.copy()
        right[:, assign == 8] = (a - b)[:, assign == 8]
        left[:, assign == 9] = (a + b)[:, assign == 9]
        m = assign == 10
        mid = a[:, m] << 1 | b[:, m] & 1
        left[:, m], right[:, m] = mid + b[:, m] >> 1, mid - b[:, m] >> 1
        got[0], got[1] = left, right
    end = (pos + 7 >> 3) + 2
    raw = np.frombuffer(data, np.uint8)
    if (end > len(raw)).any() or (ends and any(e > x for e, x in zip(end.tolist(), ends, strict=True))):
        raise Damaged("a frame runs over its end")
    first = np.array(starts, np.int64)
    if (crc16(raw, first, end - 2 - first) != raw[end - 2].astype(np.uint16) << 8 | raw[end - 1]).any():
        raise Damaged("frame checksum")
    return [np.stack([g[: samples[f], f] for g in got[: channels[f]]], axis=1) for f in range(len(heads))], end.tolist()


def decode(streams: list[bytes]) -> list[tuple[Stream, np.ndarray]]:
    """(metadata, samples by channel) of every stream; raises Damaged where a checksum does not fit."""
    opened = [open_stream(s) for s in streams]
    out: list[dict[int, np.ndarray]] = [{} for _ in streams]
    frames: list[tuple[int, int, int, int, int, int]] = []  # bits, samples, stream, place, byte, end
    for k, s in enumerate(opened):
        if s.seek and sum(n for _, _, n in s.seek) == s.total and s.seek[0][1] == 0:
            edges = [s.first + o for _, o, _ in s.seek] + [len(s.data)]
            frames += [(s.bits, n, k, j, a, b) for j, ((_, _, n), a, b) in enumerate(zip(s.seek, edges, edges[1:], strict=False))]
        else:
            at = s.first
            while at < len(s.data):
                got, (size,) = decode_frames(s.data[at:], [0], s)
                out[k][len(out[k])] = got[0]
                at += size

    def run(batch: list[tuple[int, int, int, int, int, int]]) -> None:
        starts = np.concatenate([[0], np.cumsum([b - a for *_, a, b in batch])]).tolist()
        data = b"".join(streams[k][a:b] for _, _, k, _, a, b in batch)
        got, _ = decode_frames(data, starts[:-1], opened[batch[0][2]], starts[1:])
        for (_, _, k, j, _, _), x in zip(batch, got, strict=True):
            out[k][j] = x

    frames.sort()  # like sizes together
    batch: list[tuple[int, int, int, int, int, int]] = []
    for f in frames:
        if batch and (f[0] != batch[0][0] or (len(batch) + 1) * f[1] > CELLS):
            run(batch)
            batch = []
        batch.append(f)
    if batch:
        run(batch)
    done = []
    for s, parts in zip(opened, out, strict=True):
        x = np.concatenate([parts[j] for j in range(len(parts))]) if parts else np.zeros((0, s.channels), np.int64)
        if s.total and len(x) != s.total:
            raise Damaged("samples are missing")
        width = (s.bits + 7) // 8
        pcm = x.astype("<i4").reshape(-1, 1).view(np.uint8)[:, :width].tobytes() if width > 1 else x.astype(np.int8).tobytes()
        if s.md5 != bytes(16) and hashlib.md5(pcm).digest() != s.md5:
            raise Damaged("MD5 of the samples")
        done.append((s, x))
    return done
