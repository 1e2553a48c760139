"""Hashes of words and of runs of words, for whole batches of texts at a time."""

from __future__ import annotations

import numpy as np

# Bytes between words: space and \t to \r.
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
BASE = np.uint64(0x100000001B3)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit hashes over all others."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def word_hashes(texts: list[str], between: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts in order, and each text's number of words.
    ``between`` tells for each byte of UTF-8 whether it separates words."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", "u1")
    inside = ~between[data]
    edge = np.diff(inside.astype("i1"), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    last = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, "i8")
    counts = np.diff(np.searchsorted(starts, last), prepend=0)
    if not len(starts):
        return np.zeros(0, "u8"), counts
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    power = np.cumprod(np.full(int(lengths.max()), BASE, "u8"))
    terms = (data[inside].astype("u8") + np.uint64(1)) * power[place]
    return mixed(np.add.reduceat(terms, first)), counts


def runs(words: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of every run of ``length`` words inside a text, the text's number, and the
    run's first word, counted over all texts."""
    n = max(0, len(words) - length + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    whole = text[:n] == text[length - 1:length - 1 + n]
    h = np.zeros(n, "u8")
    for i in range(length):
        h = h * MIX + words[i:i + n]
    return mixed(h[whole]), text[:n][whole], np.flatnonzero(whole)


def shingles(words: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``length`` words and each one's text, in the order of texts. A text of fewer
    words has one run of all of them; a text without words none."""
    h, text, _ = runs(words, counts, length)
    short = np.flatnonzero((counts > 0) & (counts < length))
    if len(short):
        ends = np.cumsum(counts)
        alone = np.zeros(len(short), "u8")
        for k, t in enumerate(short.tolist()):
            for w in words[ends[t] - counts[t]:ends[t]]:
                alone[k:k + 1] = alone[k:k + 1] * MIX + w
        h, text = np.concatenate([h, mixed(alone ^ MIX)]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        h, text = h[order], text[order]
    return h, text


def rolled(words: np.ndarray, length: int) -> np.ndarray:
    """The hash of every run of ``length`` words, by runs of twice the length from two halves;
    empty if there are fewer words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, "u8")
    out, done, part, size = np.zeros(n, "u8"), 0, words, 1
    while done < length:
        if length & size:
            power = np.uint64(pow(int(MIX), size, 1 << 64))
            out = out * power + part[done:done + n]
            done += size
        if done < length:
            power = np.uint64(pow(int(MIX), size, 1 << 64))
            part = part[:-size] * power + part[size:]
            size *= 2
    return mixed(out)


def word_table(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The hash of every word of all texts in order, each text's number of words, the bytes of
    all words with a space after each, and where each word begins there (and the last ends).
    A text is a string, UTF-8 bytes, or None for no words."""
    raw = [t.encode() if isinstance(t, str) else t or b"" for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", "u1")
    inside = ~BLANK[data]
    edge = np.diff(inside.view("i1"), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    last = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, "i8")
    counts = np.diff(np.searchsorted(starts, last), prepend=0)
    at = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    inside[ends] = True
    kept = data[inside]
    kept[at[1:] - 1] = 32
    if not len(starts):
        return np.zeros(0, "u8"), counts, kept, at
    place = np.arange(len(kept)) - np.repeat(at[:-1], np.diff(at))
    power = np.cumprod(np.full(int(np.diff(at).max()), BASE, "u8"))
    h = np.add.reduceat((kept.astype("u8") + np.uint64(1)) * power[place], at[:-1])
    return mixed(h), counts, kept, at
