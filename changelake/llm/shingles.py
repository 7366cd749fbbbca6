"""Word shingles of whole texts, as 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np

from .common import mix64

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = mix64(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words [^ \\t-\\r]+ with A-Z lowered, offsets of each text's words)."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    inside = np.flatnonzero(~space)
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    begin = np.empty(len(inside), bool)
    begin[0] = True
    begin[1:] = (np.diff(inside) > 1) | edge[inside[1:]]
    first = np.flatnonzero(begin)
    size = np.diff(np.r_[first, len(inside)])
    nth = np.arange(len(inside)) - np.repeat(first, size)
    far = nth >= len(_PLACE)
    place = _PLACE[np.where(far, 0, nth)]
    if far.any():
        place[far] = mix64((nth[far].astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
    hashes = mix64(np.add.reduceat(_BYTE[raw[inside]] * place, first) + size.astype(np.uint64))
    return hashes, np.searchsorted(inside[first], at, "left")


def shingle_sets(raw: np.ndarray, at: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; with fewer words, the whole sequence as one; none without words."""
    h, w = word_hashes(raw, at)
    if len(h) >= words:
        x = h[words - 1 :].copy()
        for k in range(words - 2, -1, -1):
            x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - words + 1 + k])
    else:
        x = np.zeros(0, np.uint64)
    out = []
    for a, b in zip(w[:-1].tolist(), w[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(x[a : b - words + 1]))
        elif b > a:
            whole = hashlib.blake2b(h[a:b].tobytes(), digest_size=8, person=b"short").digest()
            out.append(np.frombuffer(whole, np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    hi, lo = np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64)
    return int(hi), int(lo)
