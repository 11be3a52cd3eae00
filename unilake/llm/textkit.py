"""Vectorised word, shingle and set hashing over Arrow string columns.

Everything works on the UTF-8 bytes of a whole batch at once, so no Python
object is made per word.  Long texts are hashed in segments cut between
words: memory per batch is a small multiple of the batch's bytes.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_SEGMENT = 1 << 17
#: Least bits of a hash by which ``sorted_sets`` sorts plain numbers.
_ROOM = 16
#: Longest words that ``word_hashes`` hashes by eights of bytes.
_EIGHTS = 64
#: The first n bytes of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
#: Inverse of _P modulo 2**64.
_P_INVERSE = pow(_P, -1, 1 << 64)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_POS = [U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                       0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F,
                       0xEB44ACCAB455D165)]

#: ASCII whitespace that separates words: space and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: ASCII letters and digits and every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (wrapping arithmetic)."""
    x = x ^ (x >> U(30))
    x = x * U(_MIX[0])
    x = x ^ (x >> U(27))
    x = x * U(_MIX[1])
    return x ^ (x >> U(31))


def string_bytes(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64 if wide else np.int32)
    off = off[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the maximal runs of ``word`` bytes that stay
    inside one text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    is_word = word[data]
    start = is_word.copy()
    start[1:] &= ~is_word[:-1]
    end = is_word.copy()
    end[:-1] &= ~is_word[1:]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    start[inner] |= is_word[inner]
    end[inner - 1] |= is_word[inner - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _powers(p: int, n: int) -> np.ndarray:
    power = np.full(n, U(p))
    power[:1] = U(1)
    return np.multiply.accumulate(power)


@functools.cache
def _segment_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_P, _SEGMENT + 1), _powers(_P_INVERSE, _SEGMENT + 1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span (ascending, not overlapping).

    Positions weigh powers of one number: differences of running sums over a
    segment, divided by the power of the span's start.  With a ``seed`` they weigh
    numbers of their own, which gives an independent hash of the same spans.
    """
    out = np.empty(len(starts), dtype=U)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + _SEGMENT, side="right")))
        s, e = starts[i:j], ends[i:j]
        lens = e - s
        if seed:
            first = np.cumsum(lens) - lens
            pos = np.arange(int(lens.sum())) - np.repeat(first, lens)
            part = data[np.repeat(s, lens) + pos].astype(U) + U(1)
            power = mix64(np.arange(int(lens.max())).astype(U) + U(seed) * U(_MIX[1]))
            total = np.add.reduceat(part * power[pos], first)
        else:
            size = int(e[-1] - lo)
            power, inverse = _segment_powers() if size <= _SEGMENT else (_powers(_P, size), np.ones(1, U))
            run = np.zeros(size + 1, dtype=U)
            weighed = data[lo:e[-1]].astype(U)
            weighed += U(1)
            weighed *= power[:size]
            np.cumsum(weighed, out=run[1:])
            total = (run[e - lo] - run[s - lo]) * inverse[s - lo]
        out[i:j] = mix64(total + lens.astype(U) * _POS[6])
        i = j
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (ascending, not overlapping), eight bytes at
    a time; longer spans than ``_EIGHTS`` go through ``span_hashes``.  ``data``
    goes on for seven bytes after the last span."""
    eights = np.ndarray(max(len(data) - 7, 0), dtype="<u8", buffer=data, strides=(1,))
    size = ends - starts
    out = eights[starts] & _FIRST[np.minimum(size, 8)]
    more, at = np.flatnonzero((size > 8) & (size <= _EIGHTS)), 8
    while len(more):
        left = size[more] - at
        out[more] = mix64(out[more]) + (eights[starts[more] + at] & _FIRST[np.minimum(left, 8)])
        more, at = more[left > 8], at + 8
    long = np.flatnonzero(size > _EIGHTS)
    out[long] = span_hashes(data, starts[long], ends[long])
    return mix64(out + size.astype(U) * _POS[6])


def shingle_hashes(words: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, owner) of every run of ``width`` words of one owner; an owner
    with fewer words gives its whole sequence as one.  ``owner`` ascends."""
    n = len(words)
    if n == 0:
        return words, owner
    total = np.zeros(max(n - width + 1, 0), dtype=U)
    for j in range(width):
        total += words[j:j + len(total)] * _POS[j]
    ok = owner[:len(total)] == owner[width - 1:] if len(total) else np.zeros(0, bool)
    full, full_owner = mix64(total[ok]), owner[:len(total)][ok]
    heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    counts = np.diff(np.r_[heads, n])
    short = counts < width
    sh, sc = heads[short], counts[short]
    if not len(sh):
        return full, full_owner
    acc = sc.astype(U) * _POS[5]
    for j in range(width - 1):
        has = sc > j
        acc[has] += words[sh[has] + j] * _POS[j]
    h = np.concatenate([full, mix64(acc)])
    o = np.concatenate([full_owner, owner[sh]])
    order = np.argsort(o, kind="stable")
    return h[order], o[order]


def sorted_sets(h: np.ndarray, owner: np.ndarray, n_owners: int,
                rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each owner as one flat array plus offsets, each
    owner's part ordered by (rank, hash)."""
    n = len(h)
    top = 0 if rank is None or not n else int(rank.max()).bit_length()
    at = max(n - 1, 0).bit_length()
    room = 64 - max(n_owners - 1, 0).bit_length() - top - at
    if room >= _ROOM:  # sort plain numbers: owner, rank, first bits of the hash, place
        key = owner.astype(U)
        if top:
            key <<= U(top)
            key |= rank.astype(U)
        key <<= U(room)
        key |= h >> U(64 - room)
        key <<= U(at)
        key |= np.arange(n, dtype=U)
        key.sort()
        order = (key & U((1 << at) - 1)).view(np.int64)
        key >>= U(at)
        ordered, same = h[order], key[1:] == key[:-1]
        if not (same & (ordered[1:] != ordered[:-1])).any():
            keep = np.ones(n, dtype=bool)
            keep[1:] = ~same
            return ordered[keep], _offsets(owner[order[keep]], n_owners)
    order = np.argsort(h)
    if rank is not None:
        order = order[np.argsort(rank[order], kind="stable")]
    key = owner[order]
    key = key.astype(np.uint16) if n_owners <= 1 << 16 else key
    order = order[np.argsort(key, kind="stable")]
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[keep], _offsets(owner[keep], n_owners)


def _offsets(owner: np.ndarray, n_owners: int) -> np.ndarray:
    return np.r_[0, np.cumsum(np.bincount(owner, minlength=n_owners))].astype(np.int64)


def set_digests(h: np.ndarray, off: np.ndarray, seed: int) -> np.ndarray:
    """Order-free 64-bit digest of each set."""
    sums = np.zeros(len(off) - 1, dtype=U)
    full = off[1:] > off[:-1]
    if full.any():
        sums[full] = np.add.reduceat(mix64(h ^ mix64(np.array([seed + 1], dtype=U))),
                                     off[:-1][full])
    return mix64(sums + np.diff(off).astype(U) * _POS[6])


def chunks(sizes: np.ndarray, limit: int, most: int = 1 << 16):
    """Slices of consecutive rows whose sizes add up to about ``limit``."""
    i, n = 0, len(sizes)
    total = np.r_[0, np.cumsum(sizes)]
    while i < n:
        j = int(np.searchsorted(total, total[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + most, n)
        yield i, j
        i = j
