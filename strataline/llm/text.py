"""Text forms shared by the operators on texts."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import numpy as np

_SPACE = re.compile(r"\s+")
# The patterns behind ``guard``.
NUMBERS = re.compile(r"[+-]?\d+(?:[,.]\d+)*%?")
UNITS = re.compile(r"亿元|万元|千元|百万元|元|美元|人民币|港元|亿|万|%|百分比|百分点|千克|公斤|吨|万元/吨|usd|rmb|cny|hkd")
#: Shingles are taken modulo this prime.
PRIME = (1 << 61) - 1
#: Width of the character windows, and the length below which only equal texts match.
WINDOW, LEAST_CHARS = 5, 80


def normalized(text: str) -> str:
    """NFKC, case-folded, each run of white space one space, trimmed."""
    return _SPACE.sub(" ", unicodedata.normalize("NFKC", text).casefold()).strip()


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def guard(text: str) -> str:
    """Digest of all numbers and units of a normalized text, in order."""
    return sha256_hex(json.dumps([NUMBERS.findall(text), UNITS.findall(text)], ensure_ascii=False))


def shingles(text: str, size: int = WINDOW) -> list[int]:
    """Sorted distinct BLAKE2b values of the character windows; a shorter text is one window."""
    blake, read = hashlib.blake2b, int.from_bytes
    windows = {text[i : i + size] for i in range(max(1, len(text) - size + 1))}
    return sorted({read(blake(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") % PRIME for w in windows})


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64-bit values (public-domain splitmix64 step)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_sets(texts: list[str], size: int = WINDOW) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the character windows of each text, for sets made and compared here only.

    The texts of a batch are hashed as one run of characters; windows over a border are left out. A text shorter than a
    window is one window.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    # Borders are padded, so that even the last text has whole windows.
    codes = np.frombuffer(("".join(texts) + "\0" * size).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = np.zeros(len(codes) - size + 1, np.uint64)
    for k in range(size):
        h = mix64(h * np.uint64(0x100000001B3) + codes[k : k + len(h)] + np.uint64(1))
    ends = np.cumsum(lengths)
    out = []
    for text, first, n in zip(texts, (ends - lengths).tolist(), lengths.tolist()):
        if n < size:
            v = np.uint64(n)
            for c in text:
                v = mix64(np.array([v * np.uint64(0x100000001B3) + np.uint64(ord(c) + 1)], np.uint64))[0]
            out.append(np.array([v], np.uint64))
        else:
            out.append(np.unique(h[first : first + n - size + 1]))
    return out
