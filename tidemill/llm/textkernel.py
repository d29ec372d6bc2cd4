"""Word and shingle hashing over whole Arrow batches with numpy.

A batch of texts is one byte buffer with offsets. Word hashes come from a running sum of
position-weighted byte codes, so no Python loop runs over words. Long batches are cut between
documents into slices of a bounded number of bytes; a slice of one document may be longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


EXACT = mix64(np.arange(1, 257, dtype=np.uint64))
_CODES = EXACT[LOWER]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, b in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole documents of about limit bytes."""
    if not len(texts):
        return
    raw, off = buffers(texts)
    a = 0
    while a < len(off) - 1:
        b = int(np.searchsorted(off, off[a] + limit, "right")) - 1
        b = min(max(b, a + 1), len(off) - 1)
        yield a, b, raw[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def windows(texts: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int, bool]]:
    """(first row, end row, bytes, offsets, bytes of the row before these, whether the last row ends here): slices that cut long documents too.

    A document of over limit bytes comes in windows of its own, each cut behind white space where a window
    of that size holds any, so that no word is parted; a word of over limit bytes makes a window longer."""
    for a, b, raw, off in slices(texts, limit):
        if len(raw) <= limit:
            yield a, b, raw, off, 0, True
            continue
        at = 0
        while True:
            end = at + limit
            while end < len(raw):
                gaps = np.flatnonzero(_SEPARATOR[raw[max(at, end - limit) : end]])
                if len(gaps):
                    end = max(at, end - limit) + int(gaps[-1]) + 1
                    break
                end += limit
            end = min(end, len(raw))
            yield a, b, raw[at:end], np.asarray([0, end - at]), at, end == len(raw)
            if end == len(raw):
                break
            at = end


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words of each document) for runs of bytes other than 0x20 and 0x09-0x0D."""
    inside = ~_SEPARATOR[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = _CODES) -> np.ndarray:
    """A 64-bit hash of each word, A-Z taken as a-z; with the codes EXACT case counts."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        powers, inverse = _powers(len(raw))
        run = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(codes[raw] * powers, out=run[1:])
        return mix64((run[ends] - run[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(raw: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): each document's distinct shingle hashes, ascending, documents in order.

    A document of fewer than size words, but one at least, has its whole sequence as one shingle."""
    starts, ends, words = word_spans(raw, off)
    w = word_hashes(raw, starts, ends)
    n_docs = len(off) - 1
    made = np.maximum(words - size + 1, np.minimum(words, 1))
    out = np.zeros(int(made.sum()), np.uint64)
    first_word = np.concatenate(([0], np.cumsum(words)))
    first_out = np.concatenate(([0], np.cumsum(made)))
    with np.errstate(over="ignore"):
        odd = mix64(np.arange(11, 11 + size, dtype=np.uint64)) | np.uint64(1)
        full = np.zeros(max(len(w) - size + 1, 0), np.uint64)
        for j in range(size):
            full += w[j : len(w) - size + 1 + j] * odd[j] if len(full) else full
        long = words >= size
        if long.any():
            at = np.repeat(first_word[:-1][long] - first_out[:-1][long], made[long])
            to = np.flatnonzero(np.repeat(long, made))
            out[to] = mix64(full[to + at] + np.uint64(size))
        for d in np.flatnonzero((words > 0) & ~long):
            v = w[first_word[d] : first_word[d + 1]]
            out[first_out[d]] = mix64(np.asarray([(v * odd[: len(v)]).sum(dtype=np.uint64) + np.uint64(len(v))], np.uint64))[0]
    for a, b in zip(first_out[:-1].tolist(), first_out[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[first_out[:-1][made > 0]] = True
    doc = np.repeat(np.arange(n_docs), made)
    return out[keep], np.bincount(doc[keep], minlength=n_docs)
