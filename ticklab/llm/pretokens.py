"""Pre-tokens of ``public_tokenizers.PATTERN``, found with array operations on code points.

The pattern: contractions ('s 't 're 've 'm 'll 'd), else an optional space and a run of letters, numbers
or other visible characters, else white space; of white space before a visible character the last one is
left to the next match.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Fixed: the code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BATCH_CHARS = 1 << 18


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k in "LN":
            table[c] = LETTER if k == "L" else NUMBER
    table[WHITE_SPACE] = SPACE
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def starts(text: str, firsts: np.ndarray) -> np.ndarray:
    """Offsets in ``text`` (documents one after the other, which begin at ``firsts``) where a pre-token
    begins, ascending."""
    cp = code_points(text)
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[cp]
    new = np.zeros(n + 1, bool)
    new[firsts[firsts < n]] = new[n] = True
    first = new.copy()
    new[1:n] |= kind[1:] != kind[:-1]
    # visible run after white space of the same document: the last white space begins a token, which
    # takes the run along if it is a plain space
    b = np.flatnonzero(new[1:n] & ~first[1:n] & (kind[1:] != SPACE) & (kind[:-1] == SPACE)) + 1
    new[b - 1] = True
    new[b[cp[b - 1] == 0x20]] = False
    quote = np.flatnonzero(new[:n] & (cp == 0x27))
    if len(quote):
        stop = np.append(firsts, n)[np.searchsorted(firsts, quote, "right")]  # end of the quote's document
        nxt = [np.where(quote + k < stop, cp[np.minimum(quote + k, n - 1)], 0) for k in (1, 2)]
        size = np.zeros(len(quote), np.int64)
        for word in ("s", "t", "re", "ve", "m", "ll", "d"):
            hit = nxt[0] == ord(word[0])
            if len(word) == 2:
                hit &= nxt[1] == ord(word[1])
            size[hit & (size == 0)] = len(word) + 1
        quote, size = quote[size > 0], size[size > 0]
        new[quote + 1] = False  # the letters belong to the contraction
        new[quote + size] = True
    return np.flatnonzero(new[:n])


@functools.cache
def _mixed() -> tuple[np.ndarray, np.ndarray]:
    """Two random 64-bit numbers for every code point."""
    x = np.arange(1, 2 * 0x110000 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x[:0x110000], x[0x110000:]


_FACTOR = 0xD1342543DE82EF95  # odd: has an inverse modulo 2^64


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the factor and of its inverse."""
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, f, np.uint64))]) for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)))


def token_hashes(cp: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each token of the code points ``cp``, cut at ``begins``."""
    up, down = _powers(1 << max(18, int(len(cp)).bit_length()))
    cuts = np.append(begins, len(cp))
    out = []
    for table in _mixed():
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[cp] * up[:len(cp)])])[cuts]
        out.append((sums[1:] - sums[:-1]) * down[begins])
    return out[0], out[1]


def split_batches(texts: list[str]) -> Iterator[tuple[int, int, list[str], np.ndarray, np.ndarray]]:
    """(first text, next text, distinct pre-tokens, which of them each pre-token is, pre-tokens per text) for groups
    of texts of about BATCH_CHARS. Pre-tokens of equal 128-bit hashes are one; only distinct ones become strings."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= BATCH_CHARS):
            size += len(texts[j])
            j += 1
        whole = "".join(texts[i:j])
        lens = np.array([len(t) for t in texts[i:j]], np.int64)
        ends = np.cumsum(lens)
        begins = starts(whole, np.unique(ends - lens))
        h, check = token_hashes(code_points(whole), begins)
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        if not (check[first[which]] == check).all():  # equal in the first 64 bits only
            first = which = np.arange(len(begins))
        stop = np.append(begins[1:], len(whole))
        words = [whole[a:b] for a, b in zip(begins[first].tolist(), stop[first].tolist())]
        yield i, j, words, which, np.diff(np.searchsorted(begins, np.concatenate([[0], ends])))
        i = j
