"""Media columns: FLAC streams (mono, 8-bit, blocks of BLOCK samples) encoded and decoded with numpy.

Payload bytes become samples by a fixed one-to-one companding table: the bytes that texts use most are the samples
nearest to 0, as silence is in sound, so Rice codes are short; with table PCM a byte b is the sample b - 128. Frames hold a constant, verbatim samples, or residuals of a linear predictor
(the fixed ones of order 0 to 2, or one of order LPC_ORDER fitted to the frame) in Rice codes; the smallest is taken.
Every frame has its seek point, so frames decode independently: numpy steps all frames of a batch at once, one sample
at a time. The decoder takes any predictor order and Rice partitioning, and verifies both checksums of each frame and
the stream's MD5.

Defined results: null text is the empty payload, stored as 64 zero bytes; texts of any length are stored whole; repeated
rows give equal streams; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, documents, lean, tune, utf8, written

BLOCK, RATE, LPC_ORDER, LPC_BITS, LPC_SHIFT = 1024, 8000, 4, 12, 9
BATCH_BYTES = 1 << 20
#: The bytes frequent in texts, most frequent first; the others follow in natural order.
FREQUENT = b" etaoinshrldcumfpgwybvkj.,\n\xc3xqz\xa9THEAOINSRLDCUMFPGWYBVK"
#: Fixed predictors of order 0 to 4, as coefficients of the samples before.
FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


class Damaged(ValueError):
    """A stream breaks the format, or a checksum is wrong."""


def _companding(frequent: bytes) -> np.ndarray:
    """Samples by byte: rank 0, 1, 2, ... is the sample 0, -1, 1, -2, 2, ..."""
    order = [*frequent, *(b for b in range(256) if b not in frequent)]
    out = np.empty(256, np.int8)
    out[order] = [r >> 1 ^ -(r & 1) for r in range(256)]
    return out


TEXT = _companding(FREQUENT)
PCM = (np.arange(256) - 128).astype(np.int8)


def _inverse(table: np.ndarray) -> np.ndarray:
    out = np.empty(256, np.uint8)
    out[table.view(np.uint8)] = np.arange(256)
    return out


def _table(width: int, poly: int) -> np.ndarray:
    top, out = 1 << (width - 1), []
    for n in range(256):
        c = n << (width - 8)
        for _ in range(8):
            c = (c << 1) ^ poly if c & top else c << 1
        out.append(c & ((1 << width) - 1))
    return np.asarray(out, np.uint32)


CRC8, CRC16 = _table(8, 0x07), _table(16, 0x8005)
CRC8_LIST = CRC8.tolist()


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = CRC8_LIST[c ^ b]
    return c


def crc16(buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-16 of many spans of a buffer, in step."""
    order = np.argsort(-length, kind="stable")
    s, l = start[order], length[order]
    crc = np.zeros(len(s), np.uint32)
    active = np.searchsorted(-l, -np.arange(int(l[0]) if len(l) else 0), "left").tolist()
    for t, m in enumerate(active):
        c = crc[:m]
        crc[:m] = ((c << np.uint32(8)) & np.uint32(0xFFFF)) ^ CRC16[(c >> np.uint32(8)) ^ buffer[s[:m] + t]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def utf8_number(n: int) -> bytes:
    """FLAC's extended UTF-8 coding of a frame number."""
    if n < 0x80:
        return bytes([n])
    tail, size = [], 2
    while n >= 1 << (5 * size + 1):
        size += 1
    for _ in range(size - 1):
        tail.append(0x80 | n & 0x3F)
        n >>= 6
    return bytes([(0xFF00 >> size) & 0xFF | n, *reversed(tail)])


_headers: dict[tuple[int, int], bytes] = {}


def frame_header(number: int, size: int) -> bytes:
    if (number, size) not in _headers:
        head = b"\xff\xf8" + bytes([(0xA0 if size == BLOCK else 0x70) | 4, 0x02]) + utf8_number(number) + (b"" if size == BLOCK else struct.pack(">H", size - 1))
        if len(_headers) > 100_000:
            _headers.clear()
        _headers[number, size] = head + bytes([crc8(head)])
    return _headers[number, size]


def _lpc(x: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Quantized coefficients of each frame, by Levinson's recursion on the autocorrelation."""
    p = LPC_ORDER
    xf = x.astype(np.float64)
    r = np.empty((len(first), p + 1))
    for k in range(p + 1):
        prod = np.zeros(len(x))
        prod[k:] = xf[k:] * xf[: len(x) - k]
        prod[at < k] = 0
        r[:, k] = np.add.reduceat(prod, first)
    r[:, 0] += 1e-9 * r[:, 0] + 1.0
    a, err = np.zeros((len(first), p)), r[:, 0].copy()
    for i in range(p):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / err
        new = a.copy()
        new[:, i] = k
        new[:, :i] = a[:, :i] - k[:, None] * a[:, :i][:, ::-1]
        a, err = new, np.maximum(err * (1 - k * k), 1e-6)
    top = 1 << (LPC_BITS - 1)
    return np.clip(np.rint(a * (1 << LPC_SHIFT)), -top, top - 1).astype(np.int64)


def encode(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray = TEXT) -> list[bytes]:
    """A FLAC stream of each payload raw[offsets[i]:offsets[i + 1]]; payloads are not empty."""
    sizes = np.diff(offsets)
    per = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(sizes)), per)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    first = offsets[owner] + number * BLOCK
    n = np.minimum(BLOCK, offsets[owner + 1] - first)
    first = first - offsets[0]
    signed = table[raw]
    x = signed.astype(np.int32)
    frame = np.repeat(np.arange(len(first)), n)
    at = np.arange(len(x)) - first[frame]

    # Residuals of the candidates; samples before a predictor's order are kept as they are and cost nothing here.
    coefs = _lpc(x, first, at)
    d1 = np.zeros_like(x)
    d1[1:] = x[1:] - x[:-1]
    d2 = np.zeros_like(x)
    d2[1:] = d1[1:] - d1[:-1]
    pred = np.zeros(len(x), np.int64)
    for k in range(LPC_ORDER):
        pred[k + 1 :] += coefs[frame[k + 1 :], k] * x[: len(x) - k - 1]
    candidates = [(0, x), (1, d1), (2, d2), (LPC_ORDER, x - (pred >> LPC_SHIFT).astype(np.int32))]
    best_bits = 8 * n  # verbatim
    kind, rice = np.full(len(n), -1), np.zeros(len(n), np.int64)
    code = np.zeros(len(x), np.int64)
    for c, (order, res) in enumerate(candidates):
        u = ((res << 1) ^ (res >> 31)).astype(np.int64)
        u[at < order] = 0
        total = np.add.reduceat(u, first)
        count = np.maximum(1, n - order)
        guess = np.clip(np.floor(np.log2(np.maximum(1, total / count * 0.7))), 0, 14).astype(np.int64)
        extra = 8 * order + 10 + (9 + LPC_BITS * LPC_ORDER if c == 3 else 0)
        c_bits, c_rice = None, None
        for g in (guess, np.minimum(14, guess + 1)):
            b = extra + count * (g + 1) + np.add.reduceat(u >> g[frame], first)
            c_rice = g if c_bits is None else np.where(b < c_bits, g, c_rice)
            c_bits = b if c_bits is None else np.minimum(b, c_bits)
        better = (c_bits < best_bits) & (n > order)
        best_bits = np.where(better, c_bits, best_bits)
        kind, rice = np.where(better, c, kind), np.where(better, c_rice, rice)
        pick = better[frame]
        code[pick] = u[pick]
    same = np.maximum.reduceat(x, first) == np.minimum.reduceat(x, first)
    best_bits = np.where(same, 8, best_bits)
    kind = np.where(same, -2, kind)

    order = np.asarray([0, 1, 2, LPC_ORDER, 0, 0])[kind]  # -2 and -1 count from the end
    heads = [frame_header(a, b) for a, b in zip(number.tolist(), n.tolist(), strict=True)]
    head_len = np.fromiter(map(len, heads), np.int64, len(heads))
    body_len = (8 + best_bits + 7) // 8
    frame_len = head_len + body_len + 2
    frame_at = np.cumsum(frame_len) - frame_len
    out = np.zeros(int(frame_len.sum()) + 4, np.uint8)
    flat = np.frombuffer(b"".join(heads), np.uint8)
    out[np.repeat(frame_at - (np.cumsum(head_len) - head_len), head_len) + np.arange(len(flat))] = flat

    values, widths, ends = [], [], []

    def put(value, width, end) -> None:
        values.append(np.asarray(value, np.int64))
        widths.append(np.broadcast_to(np.asarray(width, np.int64), np.shape(value)))
        ends.append(np.asarray(end, np.int64))

    bit = 8 * (frame_at + head_len)
    # The subframe's type: constant 0, verbatim 1, fixed 8 + order, linear 31 + order; one bit below is left 0.
    put(np.asarray([8, 9, 10, 31 + LPC_ORDER, 0, 1])[kind] << 1, 8, bit + 8)
    plain = (kind == -1)[frame]
    warm = (at < order[frame]) | plain | ((kind == -2)[frame] & (at == 0))
    put((x[warm] & 0xFF), 8, bit[frame[warm]] + 16 + 8 * at[warm])
    coded = kind >= 0
    here = bit + 8 + 8 * order
    lin = kind == 3
    put(np.full(int(lin.sum()), (LPC_BITS - 1) << 5 | LPC_SHIFT), 9, here[lin] + 9)
    for k in range(LPC_ORDER):
        put(coefs[lin, k] & ((1 << LPC_BITS) - 1), LPC_BITS, here[lin] + 9 + LPC_BITS * (k + 1))
    here = here + np.where(lin, 9 + LPC_BITS * LPC_ORDER, 0)
    put(rice[coded], 10, here[coded] + 10)  # method 0, one partition, its parameter
    coded_samples = coded[frame] & (at >= order[frame])
    f, u = frame[coded_samples], code[coded_samples]
    k = rice[f]
    run = np.cumsum((u >> k) + 1 + k)
    zero = np.zeros(len(first), np.int64)
    starts = np.flatnonzero(np.r_[True, f[1:] != f[:-1]]) if len(f) else np.zeros(0, np.int64)
    zero[f[starts]] = run[starts] - ((u >> k) + 1 + k)[starts]
    put((1 << k) | (u & ((1 << k) - 1)), k + 1, here[f] + 10 + run - zero[f])

    value, width, end = np.concatenate(values), np.concatenate(widths), np.concatenate(ends)
    begin = end - width
    word = value << (24 - width - (begin & 7))
    byte = begin >> 3
    for i in range(3):
        out += np.bincount(byte + i, (word >> (16 - 8 * i)) & 0xFF, len(out))[: len(out)].astype(np.uint8)
    crc = crc16(out, frame_at, frame_len - 2)
    out[frame_at + frame_len - 2], out[frame_at + frame_len - 1] = crc >> 8, crc & 0xFF

    streams, frames, signed = [], np.cumsum(per) - per, signed.tobytes()
    data = out.tobytes()
    for i in range(len(sizes)):
        a, b = int(frames[i]), int(frames[i] + per[i])
        s0, s1 = int(offsets[i] - offsets[0]), int(offsets[i + 1] - offsets[0])
        lens, ns = frame_len[a:b], n[a:b]
        info = struct.pack(">HH", max(16, BLOCK if b - a > 1 else int(ns[0])), max(16, int(ns.max()))) + int(lens.min()).to_bytes(3, "big") + int(lens.max()).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | (s1 - s0)).to_bytes(8, "big") + hashlib.md5(signed[s0:s1]).digest()
        seek = np.zeros(b - a, [("s", ">u8"), ("o", ">u8"), ("n", ">u2")])
        seek["s"], seek["o"], seek["n"] = number[a:b] * BLOCK, frame_at[a:b] - frame_at[a], ns
        points = seek.tobytes()
        streams.append(b"fLaC" + struct.pack(">I", 34) + info + struct.pack(">I", 0x83000000 | len(points)) + points + data[int(frame_at[a]) : int(frame_at[b - 1] + frame_len[b - 1])])
    return streams


class Stream:
    """The metadata of one stream: samples, md5, and the place and length of each frame."""

    def __init__(self, data: bytes):
        if data[:4] != b"fLaC":
            raise Damaged("no FLAC stream")
        at, last, seek = 4, False, None
        while not last:
            head = int.from_bytes(data[at : at + 4], "big")
            last, kind, size = bool(head >> 31), head >> 24 & 0x7F, head & 0xFFFFFF
            body = data[at + 4 : at + 4 + size]
            at += 4 + size
            if kind == 0:
                packed = int.from_bytes(body[10:18], "big")
                if packed >> 36 & 0x1F != 7 or packed >> 41 & 7:
                    raise Damaged("not mono with 8 bits")
                self.samples, self.md5 = packed & ((1 << 36) - 1), body[18:34]
            elif kind == 3:
                seek = np.frombuffer(body, [("s", ">u8"), ("o", ">u8"), ("n", ">u2")])
        if seek is None or int(seek["n"].sum(dtype=np.int64)) != self.samples:
            raise Damaged("no seek point for each frame")
        self.first = seek["s"].astype(np.int64)
        self.count = seek["n"].astype(np.int64)
        self.at = seek["o"].astype(np.int64) + at
        self.length = np.diff(np.r_[self.at, len(data)])


def _bits(words: np.ndarray, cursor: np.ndarray, width: np.ndarray) -> np.ndarray:
    """width bits (at most 48) of each frame from its cursor on."""
    w = words[cursor >> 3] << (cursor & 7).astype(np.uint64)
    return np.where(width > 0, (w >> (np.uint64(64) - np.maximum(width, 1).astype(np.uint64))), np.uint64(0)).astype(np.int64)


def decode_frames(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, count: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(samples of all frames one after another, where each frame's begin)."""
    total = int(count.sum())
    place = np.cumsum(count) - count
    out = np.zeros(total, np.int32)
    if not len(start):
        return out, place
    crc = crc16(buffer, start, length - 2)
    if np.any(crc != (buffer[start + length - 2].astype(np.uint32) << 8 | buffer[start + length - 1])):
        raise Damaged("a frame's CRC-16 is wrong")
    padded = np.concatenate([buffer, np.zeros(16, np.uint8)])
    words = np.zeros(len(buffer) + 8, np.uint64)
    for i in range(8):
        words |= padded[i : len(buffer) + 8 + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    cursor = np.empty(len(start), np.int64)
    for i, (a, n, k) in enumerate(zip(start.tolist(), count.tolist(), number.tolist(), strict=True)):
        head = frame_header(k, n)
        if buffer[a : a + len(head)].tobytes() != head:
            raise Damaged("a frame's header is wrong")
        cursor[i] = 8 * (a + len(head))
    kind = _bits(words, cursor, np.full(len(cursor), 8)) >> 1
    cursor += 8
    for i in np.flatnonzero(kind == 0):
        out[place[i] : place[i] + count[i]] = buffer[cursor[i] >> 3].view(np.int8)
    for i in np.flatnonzero(kind == 1):
        a = cursor[i] >> 3
        out[place[i] : place[i] + count[i]] = buffer[a : a + count[i]].view(np.int8)
    coded = np.flatnonzero(kind >= 8)
    if len(coded):
        coded = coded[np.argsort(-count[coded], kind="stable")]
        _decode_coded(words, cursor[coded], kind[coded], count[coded], place[coded], out)
    return out, place


def _decode_coded(words, cursor, kind, count, place, out) -> None:
    """Frames with a predictor, longest first: their samples in step."""
    linear = kind >= 32
    order = np.where(linear, kind - 31, kind - 8)
    if np.any(~linear & (order > 4)):
        raise Damaged("unknown subframe")
    most = max(1, int(order.max()))
    m = len(kind)
    history = np.zeros((most, m), np.int64)  # the sample before, the one before that, ...
    for t in range(int(order.max())):
        on = order > t
        v = _bits(words, cursor, np.where(on, 8, 0))
        v = np.where(v > 127, v - 256, v)
        out[place[on] + t] = v[on]
        history[1:, on] = history[:-1, on]
        history[0, on] = v[on]
        cursor += np.where(on, 8, 0)
    coef, shift = np.zeros((most, m), np.int64), np.zeros(m, np.int64)
    for o in range(1, 5):
        for k, c in enumerate(FIXED[o]):
            if k < most:
                coef[k, ~linear & (order == o)] = c
    if linear.any():
        width = np.where(linear, _bits(words, cursor, np.where(linear, 4, 0)) + 1, 0)
        shift = _bits(words, cursor + 4, np.where(linear, 5, 0))
        cursor += np.where(linear, 9, 0)
        for k in range(int(order[linear].max())):
            w = np.where(linear & (order > k), width, 0)
            v = _bits(words, cursor, w)
            v = np.where((w > 0) & (v >> np.maximum(w - 1, 0) & 1 == 1), v - (1 << w), v)
            coef[k] = np.where(w > 0, v, coef[k])
            cursor += w
    method = _bits(words, cursor, np.full(m, 2))
    parts = _bits(words, cursor + 2, np.full(m, 4))
    cursor += 6
    if np.any(method > 1):
        raise Damaged("unknown residual coding")
    param_bits = 4 + method
    part_len = count >> parts
    rice, left = np.zeros(m, np.int64), part_len - order
    rice = _bits(words, cursor, param_bits)
    cursor += param_bits
    several = bool((parts > 0).any())
    if np.any(rice == (1 << param_bits) - 1):
        raise Damaged("escaped partitions are not written here")
    ends = np.searchsorted(-count, -np.arange(int(count[0])), "left").tolist()
    low_order = int(order.min())
    for t in range(low_order, int(count[0])):
        e = ends[t]
        on = order[:e] <= t
        everyone = bool(on.all())
        c = cursor[:e]
        if several:
            new = on & (left[:e] == 0)
            if new.any():
                rice[:e] = np.where(new, _bits(words, c, param_bits[:e]), rice[:e])
                c += np.where(new, param_bits[:e], 0)
                left[:e] = np.where(new, part_len[:e], left[:e])
            left[:e] -= on
        k = rice[:e]
        q = np.zeros(e, np.int64)
        w = words[c >> 3] << (c & 7).astype(np.uint64) >> np.uint64(12)  # 52 bits fit a double
        while (w == 0).any():
            z = w == 0
            q[z] += 48
            w = np.where(z, words[np.minimum((c + q) >> 3, len(words) - 1)] << ((c + q) & 7).astype(np.uint64) >> np.uint64(12), w)
            if int(q.max()) > 1 << 24:
                raise Damaged("endless code")
        q += 52 - np.frexp(w.astype(np.float64))[1]
        c2 = c + q + 1
        u = q << k | _bits(words, c2, k)
        res = (u >> 1) ^ -(u & 1)
        pred = coef[0, :e] * history[0, :e]
        for i in range(1, most):
            pred += coef[i, :e] * history[i, :e]
        value = res + (pred >> shift[:e])
        if everyone:
            cursor[:e] = c2 + k
            out[place[:e] + t] = value
            if most > 1:
                history[1:, :e] = history[:-1, :e].copy()
            history[0, :e] = value
        else:
            cursor[:e] = np.where(on, c2 + k, c)
            out[place[:e][on] + t] = value[on]
            if most > 1:
                history[1:, :e] = np.where(on, history[:-1, :e], history[1:, :e])
            history[0, :e] = np.where(on, value, history[0, :e])


def decode(streams: list[bytes], table: np.ndarray = TEXT) -> list[tuple[bytes, np.ndarray]]:
    """The payload and the samples of each stream."""
    parsed = [Stream(s) for s in streams]
    buffer = np.frombuffer(b"".join(streams), np.uint8)
    base = np.cumsum([0, *map(len, streams)])
    start = np.concatenate([p.at + b for p, b in zip(parsed, base, strict=False)])
    length, count = np.concatenate([p.length for p in parsed]), np.concatenate([p.count for p in parsed])
    number = np.concatenate([np.arange(len(p.at)) for p in parsed])
    samples, _ = decode_frames(buffer, start, length, count, number)
    signed, at, out, back = samples.astype(np.int8), 0, [], _inverse(table)
    for p in parsed:
        part = signed[at : at + p.samples]
        at += p.samples
        if hashlib.md5(part.tobytes()).digest() != p.md5:
            raise Damaged("the stream's MD5 is wrong")
        out.append((back[part.view(np.uint8)].tobytes(), part))
    return out


def padded(raw: np.ndarray, offsets: np.ndarray, multiple: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Every payload with zero bytes up to a positive multiple."""
    sizes = np.diff(offsets)
    full = np.maximum(multiple, -(-sizes // multiple) * multiple)
    at = np.r_[0, np.cumsum(full)]
    out = np.zeros(int(at[-1]), np.uint8)
    out[np.repeat(at[:-1] - offsets[:-1] + offsets[0], sizes) + np.arange(len(raw))] = raw
    return out, at


def media(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_bytes and the column media: each text's payload as a FLAC stream."""
    tune(docs.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches):
        import pyarrow as pa

        for batch in chunks(batches, BATCH_BYTES, "__text"):
            raw, at = utf8(batch.column(batch.num_columns - 1))
            streams = encode(*padded(raw, at))
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(at)), pa.array(streams, pa.binary())], names=[*keep, "n_bytes", "media"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(lean(run), f"{fields}, n_bytes long, media binary")


def feature(pcm: np.ndarray) -> str:
    """Statistics of the samples: mean, root mean square, sign changes and mean absolute step."""
    x = pcm.astype(np.int64)
    steps = np.abs(np.diff(x)).sum() / max(1, len(x) - 1)
    crossed = np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)) / max(1, len(x) - 1)
    return f"mean={x.mean():.4f};rms={np.sqrt((x * x).mean()):.4f};zcr={crossed:.6f};step={steps:.4f}"


def digests(table: DataFrame, keep: tuple[str, ...] = ("doc_id", "n_bytes")) -> DataFrame:
    """Reads the media back: keep and the digests of payload and stream, and the feature of the samples."""
    tune(table.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.select(*keep).schema)

    def run(batches):
        import pyarrow as pa

        for batch in chunks(batches, BATCH_BYTES, "media"):
            streams = batch.column(batch.num_columns - 1).to_pylist()
            decoded = decode(streams)
            payloads = [p for p, _ in decoded]
            cols = [
                pa.array([len(p) for p in payloads], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                pa.array([zlib.crc32(p[-64:]) for p in payloads], pa.int64()),
                pa.array([len(s) for s in streams], pa.int64()),
                pa.array([hashlib.sha256(s).hexdigest() for s in streams]),
                pa.array([feature(x) for _, x in decoded]),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *cols], names=[*keep, "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return table.select(*keep, "media").mapInArrow(lean(run), f"{fields}, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def pcm_blocks(table: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per frame: keep, block, sample_offset, samples and pcm (signed 8-bit)."""
    tune(table.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.select(*keep).schema)

    def run(batches):
        import pyarrow as pa

        for batch in chunks(batches, BATCH_BYTES, "media"):
            streams = batch.column(batch.num_columns - 1).to_pylist()
            rows, block, offset, pcm = [], [], [], []
            for i, (s, (_, x)) in enumerate(zip(streams, decode(streams), strict=True)):
                signed = x.tobytes()
                info = Stream(s)
                for k, (a, n) in enumerate(zip(info.first.tolist(), info.count.tolist(), strict=True)):
                    rows.append(i)
                    block.append(k)
                    offset.append(a)
                    pcm.append(signed[a : a + n])
            kept = [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(block, pa.int32()), pa.array(offset, pa.int64()), pa.array([len(x) for x in pcm], pa.int32()), pa.array(pcm, pa.binary())], names=[*keep, "block", "sample_offset", "samples", "pcm"])

    return table.select(*keep, "media").mapInArrow(lean(run), f"{fields}, block int, sample_offset long, samples int, pcm binary")


def op9_flac_media(spark, sf_dir: str) -> DataFrame:
    return digests(written(media(documents(spark, sf_dir)), "media"))
