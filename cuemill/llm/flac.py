"""FLAC streams as media columns.

`encode_payloads` stores byte strings as 8-bit mono samples in blocks of 192, each a frame with a fixed linear
predictor (order 0, 1 or 2) and Rice-coded residuals, or verbatim where that is shorter; many frames are coded
side by side in numpy. `decode_streams` reads such streams back the same way: frame starts are found by sync
code, header check sum and frame number, every frame's CRC-16 and each stream's MD5 are verified, residuals of
all frames are decoded one sample position at a time. Any other FLAC stream (stereo, LPC, partitions, escapes,
wasted bits, other widths) goes through `decode_stream`, a plain decoder of the whole format but for 32-bit
side channels. A check sum that fails raises ValueError.

`store` adds the media column and a seek table: the byte offset of every SEEK-th frame. `write_media` writes both to the
shared folder and reads them back; from there `features` decodes everything, checking the seek table, `blocks` gives the
PCM blocks between its offsets, and `read_samples` decodes only the blocks that hold the samples asked for. All are
passes with no shuffle. Long payloads are coded a million samples at a time, and decoded likewise, so that memory
beyond the stream itself is bounded.

Cases: null texts are empty; empty ones are one block of spaces; equal payloads give equal media, also repeated rows;
an empty table gives an empty one; a row without media raises ValueError; very long texts are one stream; other columns
pass through `store`, whatever their names, but for n_bytes, media and seek.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_slices

BLOCK, RATE = 192, 16000
#: Frames between two offsets of the seek table, and frames that are coded or decoded at once.
SEEK, TOGETHER = 16, 5000
_HEAD = bytes([0xFF, 0xF8, 0x10, 0x02])  # fixed blocks of 192, rate as in STREAMINFO, mono, 8 bits
#: Longest run of zeros in a Rice code of ours: any code then fits into 25 bits.
_LONGEST = 15


def _table(poly: int, bits: int) -> np.ndarray:
    out = np.arange(256, dtype=np.uint32) << (bits - 8)
    for _ in range(8):
        out = np.where(out >> (bits - 1) & 1, out << 1 ^ poly, out << 1) & ((1 << bits) - 1)
    return out


_CRC8, _CRC16 = _table(0x07, 8), _table(0x8005, 16)
_LZ16 = (16 - np.floor(np.log2(np.arange(1, 65537) - 0.5) + 1)).clip(0, 16).astype(np.int64)


def _crcs(buf: np.ndarray, begin: np.ndarray, length: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """CRC of each piece of buf: one byte position of all pieces at a time."""
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    crc = np.zeros(len(begin), np.uint32)
    left = np.searchsorted(-length, -np.arange(1, (int(length[0]) if len(length) else 0) + 1), side="right")
    for t, n in enumerate(left.tolist()):
        c = crc[:n]
        crc[:n] = (c << 8 & 0xFF00 if bits == 16 else 0) ^ table[(c >> (bits - 8)) ^ buf[begin[:n] + t]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _number(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers coded like UTF-8: bytes (n, 6) and how many count."""
    size = np.select([n < 1 << 7, n < 1 << 11, n < 1 << 16, n < 1 << 21, n < 1 << 26], [1, 2, 3, 4, 5], 6)
    out = np.zeros((len(n), 6), np.uint8)
    for s in range(1, 7):
        own = size == s
        x = n[own]
        if s == 1:
            out[own, 0] = x
        elif len(x):
            out[own, 0] = (0xFF00 >> s & 0xFF) | x >> 6 * (s - 1)
            for j in range(1, s):
                out[own, j] = 0x80 | (x >> 6 * (s - 1 - j) & 0x3F)
    return out, size


def _frames(data: np.ndarray, number: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Frames of samples (bytes of unsigned 8-bit samples, whole blocks) with the given numbers, and their lengths."""
    x = data.reshape(-1, BLOCK).astype(np.int32) - 128
    # residuals of the orders, warm-up samples as they are
    d1 = np.diff(x, axis=1)
    d2 = np.diff(d1, axis=1)
    zig = lambda r: (r << 1 ^ r >> 31).astype(np.int32)
    u = [zig(x), zig(d1), zig(d2)]
    sums = np.stack([u[0].sum(1), u[1].sum(1) + 8, u[2].sum(1) + 16])
    order = sums.argmin(0)
    coded = u[0]
    for o in (1, 2):
        own = order == o
        coded[own, o:] = u[o][own]
        coded[own, :o] = 0
    mean = coded.sum(1) / BLOCK
    k = np.floor(np.log2(np.maximum(mean * 0.7, 1))).astype(np.int64)
    most = coded.max(1)
    while (over := most >> k > _LONGEST).any():
        k[over] += 1
    raw = np.arange(BLOCK)[None, :] < order[:, None]
    q = coded >> k[:, None]
    size = q + 1 + k[:, None]
    size[raw] = 8
    bits = size.sum(1) + 8 + 10
    plain = bits >= 8 + 8 * BLOCK
    size[plain] = 8
    raw[plain] = True
    bits[plain] = 8 + 8 * BLOCK
    num, num_size = _number(number)
    head = 5 + num_size
    length = head + (bits + 7) // 8 + 2
    begin = np.cumsum(length) - length
    total = int(length.sum())
    bit = np.zeros(total * 8, np.uint8)
    at = (begin + head) * 8
    # subframe header: 0, type, 0; residual header: method 00, partition order 0, parameter
    kind = np.where(plain, 1, 8 + order)
    for j in range(6):
        bit[at + 1 + j] = kind >> (5 - j) & 1
    rice = ~plain
    place = at[rice] + 8 + 8 * order[rice] + 6
    for j in range(4):
        bit[place + j] = k[rice] >> (3 - j) & 1
    pos = np.cumsum(size, axis=1) - size + (at + 8)[:, None]
    pos += np.where(raw, 0, 10)
    if raw.any():
        p, v = pos[raw], (x[raw] & 0xFF)
        for j in range(8):
            bit[p + j] = v >> (7 - j) & 1
    mixed = raw.any(1) & rice
    bit[(pos + q)[~raw]] = 1
    for own_k in np.unique(k[rice]).tolist():
        rows = rice & (k == own_k)
        for some in (rows & ~mixed, rows & mixed):
            if own_k and some.any():
                p, v = (pos[some] + q[some] + 1), coded[some]
                if some is not rows and (raw[some]).any():
                    keep = ~raw[some]
                    p, v = p[keep], v[keep]
                for j in range(own_k):
                    bit[p + j] = v >> (own_k - 1 - j) & 1
    out = np.packbits(bit)
    for j, b in enumerate(_HEAD):
        out[begin + j] = b
    for j in range(6):
        own = num_size > j
        out[begin[own] + 4 + j] = num[own, j]
    out[begin + head - 1] = _crcs(out, begin, head - 1, _CRC8, 8)
    crc = _crcs(out, begin, length - 2, _CRC16, 16)
    out[begin + length - 2], out[begin + length - 1] = crc >> 8, crc & 0xFF
    return out.tobytes(), length


def encode_with_places(payloads: list[bytes]) -> list[tuple[bytes, np.ndarray]]:
    """payloads: each a positive multiple of 192 bytes. A FLAC stream for each, and the byte offsets of its frames."""
    if any(not p or len(p) % BLOCK for p in payloads):
        raise ValueError(f"payloads must be positive multiples of {BLOCK} bytes")
    if not payloads:
        return []
    data = np.frombuffer(b"".join(payloads), np.uint8)
    per = np.array([len(p) // BLOCK for p in payloads])
    first = np.cumsum(per) - per
    number = np.arange(len(data) // BLOCK) - np.repeat(first, per)
    made = [_frames(data[i * BLOCK : (i + TOGETHER) * BLOCK], number[i : i + TOGETHER]) for i in range(0, len(number), TOGETHER)]
    flat, length = b"".join(x[0] for x in made), np.concatenate([x[1] for x in made])
    del made
    ends = np.concatenate([[0], np.cumsum(length)])
    streams = []
    for p, a, m in zip(payloads, first.tolist(), per.tolist(), strict=True):
        own = length[a : a + m]
        info = BLOCK.to_bytes(2, "big") * 2 + int(own.min()).to_bytes(3, "big") + int(own.max()).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big")
        signed = (np.frombuffer(p, np.uint8) ^ 0x80).tobytes()
        head = b"fLaC\x80\x00\x00\x22" + info + hashlib.md5(signed).digest()
        streams.append((head + flat[ends[a] : ends[a + m]], ends[a : a + m] - ends[a] + len(head)))
    return streams


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    return [s for s, _ in encode_with_places(payloads)]


class _Bits:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def read(self, n: int) -> int:
        if not n:
            return 0
        a, b = self.at >> 3, (self.at + n + 7) >> 3
        if b > len(self.data):
            raise ValueError("the stream ends inside a frame")
        x = int.from_bytes(self.data[a:b], "big") >> (8 * b - self.at - n) & ((1 << n) - 1)
        self.at += n
        return x

    def signed(self, n: int) -> int:
        x = self.read(n)
        return x - (1 << n) if n and x >> (n - 1) else x

    def zeros(self) -> int:
        n = 0
        while not self.read(1):
            n += 1
        return n


def _crc(data: bytes, table: np.ndarray, bits: int) -> int:
    c, t, mask = 0, table.tolist(), (1 << bits) - 1
    for b in data:
        c = (c << 8 & mask) ^ t[c >> (bits - 8) ^ b]
    return c


def _residual(r: _Bits, count: int, order: int) -> list[int]:
    wide = {0: 4, 1: 5}.get(r.read(2))
    if wide is None:
        raise ValueError("reserved residual coding")
    parts = 1 << r.read(4)
    out: list[int] = []
    for part in range(parts):
        n = count // parts - (order if part == 0 else 0)
        k = r.read(wide)
        if k == (1 << wide) - 1:
            w = r.read(5)
            out += [r.signed(w) for _ in range(n)]
        else:
            for _ in range(n):
                u = r.zeros() << k
                u |= r.read(k)
                out.append(u >> 1 ^ -(u & 1))
    return out


#: Coefficients of the format's fixed predictors, nearest sample first.
_FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


def _subframe(r: _Bits, count: int, width: int) -> list[int]:
    if r.read(1):
        raise ValueError("subframe padding is set")
    kind, wasted = r.read(6), 0
    if r.read(1):
        wasted = r.zeros() + 1
    width -= wasted
    if kind == 0:
        out = [r.signed(width)] * count
    elif kind == 1:
        out = [r.signed(width) for _ in range(count)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 8 if kind < 32 else kind - 31
        out = [r.signed(width) for _ in range(order)]
        shift, weights = 0, _FIXED.get(order, [])
        if kind >= 32:
            precision = r.read(4) + 1
            shift = r.signed(5)
            weights = [r.signed(precision) for _ in range(order)]
        for e in _residual(r, count, order):
            out.append(e + (sum(w * out[-1 - j] for j, w in enumerate(weights)) >> shift))
    else:
        raise ValueError("reserved subframe type")
    return [v << wasted for v in out] if wasted else out


def stream_info(data: bytes) -> tuple[dict, int]:
    """STREAMINFO and where the first frame begins."""
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, info = 4, None
    while True:
        last, kind, size = data[at] >> 7, data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        if kind == 0:
            b = data[at + 4 : at + 4 + size]
            x = int.from_bytes(b[10:18], "big")
            info = {"block": int.from_bytes(b[2:4], "big"), "rate": x >> 44, "channels": (x >> 41 & 7) + 1, "width": (x >> 36 & 31) + 1, "samples": x & (1 << 36) - 1, "md5": bytes(b[18:34])}
        at += 4 + size
        if last:
            break
    if info is None:
        raise ValueError("no STREAMINFO")
    return info, at


def decode_stream(data: bytes) -> tuple[dict, list[list[int]], list[tuple[int, int]]]:
    """STREAMINFO, samples by channel, and (first sample, byte offset) of each frame. Check sums are verified."""
    info, at = stream_info(data)
    channels: list[list[int]] = [[] for _ in range(info["channels"])]
    offsets = []
    while at < len(data):
        r = _Bits(data)
        r.at = at * 8
        if r.read(14) != 0x3FFE or r.read(1):
            raise ValueError("no sync code")
        r.read(1)
        size_code, rate_code, assigned, width_code = r.read(4), r.read(4), r.read(4), r.read(3)
        r.read(1)
        lead = r.read(8)
        for _ in range(0 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length() - 1):
            r.read(8)
        count = 192 if size_code == 1 else 576 << (size_code - 2) if 2 <= size_code <= 5 else r.read(8) + 1 if size_code == 6 else r.read(16) + 1 if size_code == 7 else 256 << (size_code - 8)
        if rate_code in (12, 13, 14):
            r.read(8 if rate_code == 12 else 16)
        width = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}.get(width_code, info["width"])
        if _crc(data[at : r.at >> 3], _CRC8, 8) != r.read(8):
            raise ValueError("frame header check sum")
        if assigned < 8:
            own = [_subframe(r, count, width) for _ in range(assigned + 1)]
        else:
            side = {8: (0, 1), 9: (1, 0), 10: (0, 1)}[assigned]
            a, b = _subframe(r, count, width + side[0]), _subframe(r, count, width + side[1])
            if assigned == 8:
                own = [a, [x - y for x, y in zip(a, b, strict=True)]]
            elif assigned == 9:
                own = [[x + y for x, y in zip(a, b, strict=True)], b]
            else:
                mid = [x << 1 | y & 1 for x, y in zip(a, b, strict=True)]
                own = [[(m + y) >> 1 for m, y in zip(mid, b, strict=True)], [(m - y) >> 1 for m, y in zip(mid, b, strict=True)]]
        r.at = -(-r.at // 8) * 8
        end = r.at >> 3
        if _crc(data[at:end], _CRC16, 16) != r.read(16):
            raise ValueError("frame check sum")
        offsets.append((len(channels[0]), at))
        for c, o in zip(channels, own, strict=True):
            c += o
        at = end + 2
    if any(info["md5"]):
        bytes_each = -(-info["width"] // 8)
        flat = b"".join(int(v).to_bytes(bytes_each, "little", signed=True) for row in zip(*channels, strict=True) for v in row)
        if hashlib.md5(flat).digest() != info["md5"]:
            raise ValueError("MD5 of the samples")
    return info, channels, offsets


def _decode_frames(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Samples (n, 192) of frames of our profile, and which could be decoded so. buf has 8 spare bytes."""
    n = len(begin)
    lead = buf[begin + 4]
    head = 5 + np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC], [1, 2, 3, 4, 5], 6)
    good = _crcs(buf, begin, head - 1, _CRC8, 8) == buf[begin + head - 1]
    good &= _crcs(buf, begin, np.maximum(end - begin - 2, 0), _CRC16, 16) == (buf[end - 2].astype(np.uint32) << 8 | buf[end - 1])
    if not good.all():
        raise ValueError("frame check sum")
    b = buf.astype(np.uint32)
    window = b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
    at = begin + head
    kind = buf[at].astype(np.int64) >> 1
    order = np.where((kind >= 8) & (kind <= 10), kind - 8, 0)
    verbatim = kind == 1
    ok = (verbatim | ((kind >= 8) & (kind <= 10))) & (buf[at] & 0x81 == 0)
    out = np.zeros((n, BLOCK), np.int32)
    if verbatim.any():
        out[verbatim] = buf[(at[verbatim] + 1)[:, None] + np.arange(BLOCK)].view(np.int8)
    rows = np.flatnonzero(ok & ~verbatim)
    if len(rows):
        o = order[rows]
        for w in (0, 1):
            own = rows[o > w]
            out[own, w] = buf[at[own] + 1 + w].view(np.int8)
        p = (at[rows] + 1 + o) * 8
        header = window[p >> 3] >> 22  # method, partition order, parameter
        ok[rows[header >> 4 != 0]] = False
        k = (header & 15).astype(np.int64)
        ok[rows[k == 15]] = False
        p += 10
        mask = (1 << k) - 1
        last = (len(window) - 1) * 8
        coded = np.zeros((BLOCK, len(rows)), np.int64)
        lost = np.zeros(len(rows), bool)
        for j in range(BLOCK):
            np.minimum(p, last, out=p)
            w = (window[p >> 3].astype(np.int64) << (p & 7)) & 0xFFFFFFFF
            q = _LZ16[w >> 16]
            if j < 2:
                wait = o > j
                lost |= (q > _LONGEST) & ~wait
                coded[j] = np.where(wait, 0, q << k | w >> (31 - q - k) & mask)
                p += np.where(wait, 0, q + 1 + k)
            else:
                lost |= q > _LONGEST
                coded[j] = q << k | w >> np.maximum(31 - q - k, 0) & mask
                p += q + 1 + k
        ok[rows[lost]] = False
        r = (coded >> 1 ^ -(coded & 1)).T.astype(np.int32)
        for d in (0, 1, 2):
            own = o == d
            if not own.any():
                continue
            v, s = r[own], out[rows[own]]
            if d == 1:
                v[:, 0] = s[:, 0]
                v = np.cumsum(v, axis=1)
            elif d == 2:
                step = v.copy()
                step[:, 0] = 0
                step[:, 1] = s[:, 1] - s[:, 0]
                step = np.cumsum(step, axis=1)
                step[:, 0] = s[:, 0]
                v = np.cumsum(step, axis=1)
            out[rows[own]] = v
    return out, ok


def decode_frames_from(part: bytes, number: int) -> bytes:
    """Samples of whole frames of our profile, cut from a stream at a place of its seek table, numbered from `number`."""
    buf = np.frombuffer(part + bytes(8), np.uint8)
    hit = np.flatnonzero(buf[:-3] == _HEAD[0])
    for j in (1, 2, 3):
        hit = hit[buf[hit + j] == _HEAD[j]]
    num, size = _number(np.arange(number, number + len(hit)))
    begin: list[int] = []
    for at in hit.tolist():  # the head's four bytes may also occur inside a frame: the number after them tells
        n, own = num[len(begin)], int(size[len(begin)])
        if bytes(buf[at + 4 : at + 4 + own]) == bytes(n[:own]):
            begin.append(at)
    samples, ok = _decode_frames(buf, np.array(begin, np.int64), np.array([*begin[1:], len(part)], np.int64))
    if not ok.all():
        raise ValueError("not frames of this profile")
    return (samples.astype(np.int8).view(np.uint8) ^ 0x80).tobytes()


def decode_streams(streams: list[bytes]) -> list[tuple[np.ndarray, list[tuple[int, int]]]]:
    """Unsigned 8-bit samples as bytes, and (first sample, byte offset) of the frames, of each mono 8-bit stream."""
    buf = np.frombuffer(b"".join(streams) + bytes(8), np.uint8)
    size = np.array([len(s) for s in streams])
    base = np.cumsum(size) - size
    infos = [stream_info(s) for s in streams]
    hit = np.flatnonzero(buf[:-3] == _HEAD[0])
    for j in (1, 2, 3):
        hit = hit[buf[hit + j] == _HEAD[j]]
    owner = np.searchsorted(base, hit, side="right") - 1
    hit, owner = hit[hit >= base[owner] + np.array([x[1] for x in infos])[owner]], owner[hit >= base[owner] + np.array([x[1] for x in infos])[owner]]
    cut = np.searchsorted(owner, np.arange(len(streams) + 1))
    fast, begin, end = [], [], []
    for i, (info, _) in enumerate(infos):
        own = hit[cut[i] : cut[i + 1]]
        expect = info["samples"] // BLOCK
        if info["block"] == BLOCK and info["channels"] == 1 and info["width"] == 8 and info["samples"] % BLOCK == 0 and len(own) == expect and expect < 1 << 31:
            num, n = _number(np.arange(expect))
            if all((buf[own[n > j] + 4 + j] == num[n > j, j]).all() for j in range(6)):
                fast.append(i)
                begin.append(own)
                end.append(np.append(own[1:], base[i] + size[i]))
    out: list = [None] * len(streams)
    if fast:
        b, e = np.concatenate(begin), np.concatenate(end)
        samples, ok = np.empty((len(b), BLOCK), np.int8), np.empty(len(b), bool)
        for i in range(0, len(b), TOGETHER):
            part = slice(i, i + TOGETHER)
            low = int(b[part].min())
            samples[part], ok[part] = _decode_frames(buf[low : int(e[part].max()) + 8], b[part] - low, e[part] - low)
        at = 0
        for i, own in zip(fast, begin, strict=True):
            if ok[at : at + len(own)].all():
                signed = samples[at : at + len(own)].reshape(-1)
                if hashlib.md5(signed.tobytes()).digest() != infos[i][0]["md5"]:
                    raise ValueError("MD5 of the samples")
                out[i] = (signed.view(np.uint8) ^ 0x80, list(zip(range(0, len(signed), BLOCK), (own - base[i]).tolist(), strict=True)))
            at += len(own)
    for i, s in enumerate(streams):
        if out[i] is None:
            info, channels, offsets = decode_stream(s)
            if info["channels"] != 1 or info["width"] != 8:
                raise ValueError("not a mono 8-bit stream")
            out[i] = (np.array(channels[0], np.int8).view(np.uint8) ^ 0x80, offsets)
    return out


def payload(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b" " * (-len(raw) % BLOCK if raw else BLOCK)


def store(docs: DataFrame, *, text: str = "text", media: str = "media") -> DataFrame:
    """docs without the text, with n_bytes, the media column and its seek table."""
    docs = docs.drop("n_bytes", media, "seek")
    rest = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*rest, T.StructField("n_bytes", T.LongType()), T.StructField(media, T.BinaryType()), T.StructField("seek", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            made = encode_with_places([payload(t) for t in texts])
            streams, seeks = [x for x, _ in made], [places[::SEEK].tolist() for _, places in made]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), pa.array(sizes, pa.int64()), pa.array(streams, pa.binary()), pa.array(seeks, pa.list_(pa.int64()))], names=[*(f.name for f in rest), "n_bytes", media, "seek"])

    return docs.mapInArrow(run, schema)


def write_media(docs: DataFrame, *, text: str = "text", media: str = "media") -> DataFrame:
    """The rows of `store`, written to the shared folder and read back."""
    return staged(store(docs, text=text, media=media), "media", compression="zstd")  # a quarter less than the streams


def _media_slices(batches: Iterator[pa.RecordBatch], media: str) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    for batch, streams in text_slices(batches, media):
        if None in streams:
            raise ValueError("a row without media")
        yield batch, streams, decode_streams(streams)


def blocks(stored: DataFrame, *, key: str = "doc_id", media: str = "media") -> DataFrame:
    """key, block, first_sample, byte_offset, pcm: the stream's samples in blocks of SEEK frames, with the place of each
    block's first sample and first byte, so that a reader can seek to any sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, decoded in _media_slices(batches, media):
            rows = [(k, i // SEEK, a, at, pcm[a : a + SEEK * BLOCK].tobytes()) for k, (pcm, places) in zip(batch.column("key").to_pylist(), decoded, strict=True) for i, (a, at) in enumerate(places) if i % SEEK == 0]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["key", "block", "first_sample", "byte_offset", "pcm"])

    return stored.select(F.col(key).cast("long").alias("key"), media).mapInArrow(run, "key long, block int, first_sample long, byte_offset long, pcm binary").withColumnRenamed("key", key)


def read_samples(stored: DataFrame, begin: int, end: int, *, key: str = "doc_id", media: str = "media") -> DataFrame:
    """key, pcm: the samples from begin to end (without it) that each stream has. Of the media only the bytes between
    the seek table's offsets around them are taken, by substring, and decoded."""
    first, last = begin // (SEEK * BLOCK), max(begin, end - 1) // (SEEK * BLOCK)
    low = F.get("seek", F.lit(first))
    high = F.coalesce(F.get("seek", F.lit(last + 1)), F.length(media).cast("long"))
    part = F.col(media).substr((low + 1).cast("int"), (high - low).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parts in text_slices(batches, "part"):
            found = []
            for x in parts:
                pcm = decode_frames_from(x, first * SEEK) if x else b""
                found.append(pcm[begin - first * SEEK * BLOCK : end - first * SEEK * BLOCK])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.binary())], ["key", "pcm"])

    return stored.select(F.col(key).cast("long").alias("key"), part.alias("part")).mapInArrow(run, "key long, pcm binary").withColumnRenamed("key", key)


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_blocks long"


def features(stored: DataFrame, *, media: str = "media") -> DataFrame:
    """Digests and a description of the samples, read back from the stored bytes: mean level, mean power, crossings
    of the middle level in a thousand samples, and peak. A seek table that doesn't fit its stream raises ValueError."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, streams, decoded in _media_slices(batches, media):
            rows = []
            for s, (pcm, places), seek in zip(streams, decoded, batch.column("seek").to_pylist(), strict=True):
                if [at for _, at in places[::SEEK]] != seek:
                    raise ValueError("the seek table")
                data, x = pcm.tobytes(), pcm.astype(np.int16) - 128
                crossed = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
                power = int(np.dot(y := x.astype(np.float64), y))
                text = f"mean={int(x.sum(dtype=np.int64)) / len(x):.4f};power={power / len(x):.3f};crossings={1000 * crossed / len(x):.3f};peak={int(np.abs(x).max())}"
                rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(s), hashlib.sha256(s).hexdigest(), text, len(seek)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], [x.split(" ")[0] for x in FEATURES.split(", ")])

    return stored.select(F.col("doc_id").cast("long"), "n_bytes", media, "seek").mapInArrow(run, FEATURES)
