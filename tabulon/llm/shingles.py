"""Distinct word shingles of many texts at once, as 64-bit hashes (numpy)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def words_of(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple:
    """(begin, end, text number, hash) of every word. Text k is the bytes
    ``raw[offsets[k]:offsets[k + 1]]``; words are split at white space."""
    with np.errstate(over="ignore"):
        chars = _LOWER[raw] if lower else raw
        space = _SPACE[chars]
        border = np.zeros(len(raw) + 1, dtype=bool)
        border[offsets] = True
        begins = ~space
        begins[1:] &= space[:-1] | border[1:-1]
        ends = ~space
        ends[:-1] &= space[1:] | border[1:-1]
        a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        return a, b, np.searchsorted(offsets, a, side="right") - 1, span_hashes(chars, a, b)


#: Bytes of a long text that are split into words at once.
PIECE = 1_000_000
#: Longer spans are hashed one by one.
LONG_SPAN = 512
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U)


def _eights(chars: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as numbers (zeros after the end)."""
    padded = np.zeros(len(chars) + 8, dtype=np.uint8)
    padded[:len(chars)] = chars
    return np.ndarray((len(chars) + 1,), dtype="<u8", buffer=padded, strides=(1,))


def same_spans(left: np.ndarray, a: np.ndarray, right: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Are the bytes of left[a:a + length] those of right[b:b + length]?"""
    same = np.ones(len(a), dtype=bool)
    far = np.flatnonzero(length > LONG_SPAN)
    for k in far.tolist():
        same[k] = np.array_equal(left[a[k]:a[k] + length[k]], right[b[k]:b[k] + length[k]])
    one = _eights(left)
    two = one if right is left else _eights(right)
    alive = np.flatnonzero((length > 0) & (length <= LONG_SPAN))
    done = 0
    while len(alive):
        differ = (one[a[alive] + done] ^ two[b[alive] + done]) & _TAIL[np.minimum(length[alive] - done, 8)]
        same[alive[differ != 0]] = False
        done += 8
        alive = alive[(differ == 0) & (length[alive] > done)]
    return same


def span_hashes(chars: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [a, b): eight bytes at a time go through a bijection that starts with
    the length, so spans of up to eight bytes never collide and longer ones only by chance."""
    with np.errstate(over="ignore"):
        eight = _eights(chars)
        length = b - a
        out = mix(length.astype(U) + U(0x9E3779B97F4A7C15))
        alive, at, left = np.arange(len(a)), a, length
        far = np.flatnonzero(length > LONG_SPAN)
        if len(far):
            near = length <= LONG_SPAN
            alive, at, left = alive[near], at[near], left[near]
        while len(alive):
            out[alive] = mix(out[alive] ^ (eight[at] & _TAIL[np.minimum(left, 8)])) + U(0xD1B54A32D192ED03)
            more = left > 8
            alive, at, left = alive[more], at[more] + 8, left[more] - 8
        for k in far.tolist():
            digest = hashlib.blake2b(chars[a[k]:b[k]].tobytes(), digest_size=8).digest()
            out[k] = U(int.from_bytes(digest, "little"))
        return out


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every word, letters A-Z lowered. A single long text goes in pieces of
    about ``PIECE`` bytes that end at white space, so only its hashes are as long as the text."""
    if len(offsets) > 2 or len(raw) <= 2 * PIECE:
        return words_of(raw, offsets)[2:]
    found, start = [], 0
    while start < len(raw):
        end = min(start + PIECE, len(raw))
        while end < len(raw) and not _SPACE[raw[end:end + PIECE]].any():
            end = min(end + PIECE, len(raw))
        if end < len(raw):
            end += int(_SPACE[raw[end:end + PIECE]].argmax())
        found.append(words_of(raw[start:end], np.array([0, end - start]))[3])
        start = end
    hashed = np.concatenate(found)
    return np.zeros(len(hashed), dtype=np.int64), hashed


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles, sorted by both. Letters A-Z are lowered; a text
    of fewer words than ``width`` has its whole sequence as its one shingle, a text without words
    has none."""
    with np.errstate(over="ignore"):
        n_texts = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
        text, word = word_hashes(raw, offsets)
        per_text = np.bincount(text, minlength=n_texts)
        fold = np.zeros(max(0, len(word) - width + 1), dtype=U)
        for k in range(width):
            fold = fold * U(0xD6E8FEB86659FD93) + word[k:k + len(fold)]
        whole = text[:len(fold)] == text[width - 1:] if len(fold) else np.zeros(0, dtype=bool)
        owner, hashed = text[:len(fold)][whole], mix(fold[whole] + U(width))
        few = np.flatnonzero((per_text > 0) & (per_text < width))
        if len(few):
            first = np.cumsum(per_text) - per_text
            short = np.zeros(len(few), dtype=U)
            for k in range(width - 1):
                has = per_text[few] > k
                at = np.minimum(first[few] + k, len(word) - 1)
                short = np.where(has, short * U(0xD6E8FEB86659FD93) + word[at], short)
            owner = np.concatenate([owner, few])
            hashed = np.concatenate([hashed, mix(short + per_text[few].astype(U))])
        order = np.lexsort((hashed, owner))
        owner, hashed = owner[order], hashed[order]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
        return owner[new], hashed[new]


def text_batches(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, raw bytes, offsets) of row ranges with about ``limit`` bytes of text."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        end = min(end, len(texts))
        own = offsets[start:end + 1]
        yield start, end, raw[own[0]:own[-1]], own - own[0]
        start = end
