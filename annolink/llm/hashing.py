"""Hashes of words (xxh3): of short ones for whole arrays at once, of long ones remembered within a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

# Words whose hash a task remembers, and bytes of those that are hashed at once.
REMEMBERED, SHORT = 400_000, 16
# Texts are handled in pieces of about so many bytes.
PIECE = 500_000
_LOWER, _BLANK = np.arange(256, dtype=np.uint8), np.zeros(256, bool)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
# What xxh3 of words of at most 3, 8 and 16 bytes begins with (from its fixed secret).
_FLIP3, _FLIP8, _FLIP16 = np.uint64(0x87275A9B), np.uint64(0xC73AB174C5ECD5A2), np.array([0x6782737BEA4239B9, 0xAF56BC3B0996523A], np.uint64)
_LOW = np.uint64(0xFFFFFFFF)


def _bits(n: int) -> np.uint64:
    return np.uint64(n)


def _short(first: np.ndarray, middle: np.ndarray, last: np.ndarray, n: np.ndarray) -> np.ndarray:
    h = (first << _bits(16) | middle << _bits(24) | last | n << _bits(8)) ^ _FLIP3
    h = (h ^ h >> _bits(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> _bits(29)) * np.uint64(0x165667B19E3779F9)
    return h ^ h >> _bits(32)


def _middle(first: np.ndarray, last: np.ndarray, n: np.ndarray) -> np.ndarray:
    h = (last + (first << _bits(32))) ^ _FLIP8
    h = h ^ (h << _bits(49) | h >> _bits(15)) ^ (h << _bits(24) | h >> _bits(40))
    h = h * np.uint64(0x9FB21C651E98DF25)
    h = (h ^ (h >> _bits(35)) + n) * np.uint64(0x9FB21C651E98DF25)
    return h ^ h >> _bits(28)


def _longer(first: np.ndarray, last: np.ndarray, n: np.ndarray) -> np.ndarray:
    x, y = first ^ _FLIP16[0], last ^ _FLIP16[1]
    a, b, c, d = x & _LOW, x >> _bits(32), y & _LOW, y >> _bits(32)
    # The upper half of the product of 128 bits.
    across = (a * c >> _bits(32)) + (b * c & _LOW) + a * d
    upper = (b * c >> _bits(32)) + (across >> _bits(32)) + b * d
    h = n + x.byteswap() + y + (x * y ^ upper)
    h = (h ^ h >> _bits(37)) * np.uint64(0x165667919E3779F9)
    return h ^ h >> _bits(32)


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def of_texts(self, texts: pa.Array):
        """(hashes of the words, A-Z in lower case, of some texts in order; their number per text), piece by piece."""
        if not len(texts):
            return
        kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data or b"", np.uint8)
        # A text weighs a little more than its bytes: the empty ones are not all in one piece.
        weights, i = offsets + 8 * np.arange(len(offsets)), 0
        while i < len(texts):
            j = min(max(i + 1, int(np.searchsorted(weights, weights[i] + PIECE))), len(texts))
            yield self._piece(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            i = j

    def _piece(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        buffer = np.full(len(data) + SHORT, 0x20, np.uint8)
        buffer[: len(data)] = _LOWER[data]
        inside = ~_BLANK[buffer[: len(data) + 1]]
        # Words start and end where the kind of the bytes changes, and between texts.
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        between = offsets[(offsets > 0) & (offsets < len(data))]
        start[between], end[between - 1] = inside[between], inside[between - 1]
        starts = np.flatnonzero(start)
        lengths = np.flatnonzero(end) + 1 - starts
        return self._words(buffer, starts, lengths), np.diff(np.searchsorted(starts, offsets))

    def _words(self, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        hashes, n = np.empty(len(starts), np.uint64), lengths.astype(np.uint64)
        # The 4 and the 8 bytes from each place on.
        four, eight = (np.ndarray((len(buffer) - k + 1,), f"<u{k}", buffer, strides=(1,)) for k in (4, 8))
        at = np.flatnonzero(lengths < 4)
        i, k = starts[at], lengths[at]
        hashes[at] = _short(*(buffer[p].astype(np.uint64) for p in (i, i + (k >> 1), i + k - 1)), n[at])
        at = np.flatnonzero((lengths >= 4) & (lengths <= 8))
        i, k = starts[at], lengths[at]
        hashes[at] = _middle(four[i].astype(np.uint64), four[i + k - 4].astype(np.uint64), n[at])
        at = np.flatnonzero((lengths > 8) & (lengths <= SHORT))
        i, k = starts[at], lengths[at]
        hashes[at] = _longer(eight[i], eight[i + k - 8], n[at])
        at = np.flatnonzero(lengths > SHORT)
        if len(at):
            text = buffer.tobytes()
            hashes[at] = self.of([text[i : i + k] for i, k in zip(starts[at].tolist(), lengths[at].tolist(), strict=True)])
        return hashes
