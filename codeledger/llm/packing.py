"""Word numbers, rolling hashes and packed key blocks, for use inside tasks.

A block is the sorted, distinct keys of one shard that fall into one part of
the key range.  Blocks, not rows of single keys, go through the shuffle.
"""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard

#: Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Vocabulary(dict):
    """Word to number, numbers given in order of first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def index_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, words per text, and two 64-bit hashes per number.

    Words are cut at ASCII white space; a null text has none.
    """
    vocabulary, lengths, numbers = Vocabulary(), np.zeros(len(texts), np.int64), [np.zeros(0, np.uint32)]
    for i, text in enumerate(texts):
        if text and (words := text.split()):
            lengths[i] = len(words)
            numbers.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
    digests = b"".join(map(xxhash.xxh3_128_digest, vocabulary))
    return np.concatenate(numbers), lengths, np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2)


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each ``width`` neighbours."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    total, done, run, span = None, 0, hashes, 1
    while span <= width:
        power = np.uint64(pow(base, span, 1 << 64))
        if width & span:
            total = run if total is None else total[: len(run) - done] * power + run[done:]
            done += span
        if 2 * span <= width:
            run = run[:-span] * power + run[span:]
        span *= 2
    return total


def distinct(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): a stable order by (key, check), and where in it a new pair begins."""
    order = np.argsort(keys, kind="stable")
    ks, cs = keys[order], checks[order]
    equal = ks[1:] == ks[:-1]
    if (equal & (cs[1:] != cs[:-1])).any():
        order = np.lexsort((checks, keys))
        ks, cs = keys[order], checks[order]
        equal = (ks[1:] == ks[:-1]) & (cs[1:] == cs[:-1])
    return order, np.concatenate([np.ones(min(1, len(keys)), bool), ~equal])


def cut(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, from, to) of the parts of the key range that sorted ``keys`` fall into."""
    if not len(keys):
        return []
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    starts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
    ends = np.append(starts[1:], len(keys))
    return list(zip(part[starts].tolist(), starts.tolist(), ends.tolist(), strict=True))


def pack(values: np.ndarray) -> bytes:
    """Values as compressed byte planes, so that equal high bytes cost nothing."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)
