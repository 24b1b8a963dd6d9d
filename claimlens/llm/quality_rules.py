"""Quality rules as a short-circuit cascade.

Base figures are computed for every text; texts that fail the base rules stop there.  The other rules are a
conjunction, so their order changes the cost and not the verdict: each task evaluates all of them on its first
``sample_texts`` texts, measures what a text costs and how many it rejects, orders the rules by rejections per cost,
and from then on runs each rule only on the texts that the rules before it kept.

Null and empty texts have zero figures and fail the base rules.  Rows are taken as they come, every column of the
input is kept, and a clashing name gets an underscore; an empty table stays empty.  Very long texts are read whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import SPACE, append_columns, mix64, run_sums, text_bytes, word_spans

WINDOW = 8
MIN_WORDS = 20
SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWERED = np.zeros(256, bool)
_LOWERED[0x61:0x7B] = True
_LETTER = _UPPER | _LOWERED
_LETTER[0x80:] = True                                            # bytes of characters beyond ASCII
_FIRST_BYTE = np.ones(256, bool)
_FIRST_BYTE[0x80:0xC0] = False                                   # the other bytes of a character


class TextSlice:
    """Byte and word views of a slice of texts."""

    def __init__(self, texts: pa.Array):
        self.flat, self.offsets = text_bytes(texts)
        self.first, self.last, self.words = word_spans(self.flat, self.offsets)
        self.n_words = np.diff(self.words)

    def of_texts(self, per_byte: np.ndarray) -> np.ndarray:
        return run_sums(per_byte, self.offsets)

    def words_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words of the given texts, bounds of each text's words among them)."""
        sizes = self.n_words[which]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return np.repeat(self.words[which] - bounds[:-1], sizes) + np.arange(bounds[-1]), bounds

    def codes(self) -> np.ndarray:
        """A number for each word, equal where the words are equal."""
        if not hasattr(self, "_codes"):
            sizes = self.last - self.first
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            visible = np.ascontiguousarray(self.flat[~SPACE[self.flat]])
            words = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(visible)])
            self._codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return self._codes


def repeated_words(codes: np.ndarray, words: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text, the words inside windows that its text has twice or more (the first one included).

    ``codes``: word numbers of all texts; ``words``: bounds of each text.  Windows are found by a 64-bit hash, and
    equal hashes are compared word by word.
    """
    n = len(codes)
    if n < window:
        return np.zeros(len(words) - 1, np.int64)
    text = np.repeat(np.arange(len(words) - 1), np.diff(words))
    starts = np.flatnonzero(text[:n - window + 1] == text[window - 1:])
    mixed = mix64(codes + 1)
    hashed = mix64(text[starts] + 7)
    with np.errstate(over="ignore"):
        for k in range(window):
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + mixed[starts + k]
    order = np.argsort(hashed, kind="stable")
    ranked = hashed[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    a, b = starts[order[same]], starts[order[same + 1]]
    alike = text[a] == text[b]
    for k in range(window):
        alike &= codes[a + k] == codes[b + k]
    if not alike.all():                                          # two windows with one hash: compare them all as tuples
        return np.array([_repeated_words(codes[words[i]:words[i + 1]].tolist(), window) for i in range(len(words) - 1)], np.int64)
    change = np.zeros(n + 1, np.int64)
    hit = np.unique(np.concatenate([a, b]))
    change[hit] += 1
    np.subtract.at(change, hit + window, 1)
    return run_sums((np.cumsum(change[:-1]) > 0).astype(np.int64), words)


def _repeated_words(codes: list, window: int) -> int:
    places: dict[tuple, list[int]] = {}
    for i in range(len(codes) - window + 1):
        places.setdefault(tuple(codes[i:i + window]), []).append(i)
    return len({i + k for found in places.values() if len(found) > 1 for i in found for k in range(window)})


def duplicate_lines(s: TextSlice) -> np.ndarray:
    data, out = s.flat.tobytes(), np.zeros(len(s.offsets) - 1, np.int64)
    for i in np.flatnonzero(s.of_texts(s.flat == 0x0A)):
        lines = [x for x in data[s.offsets[i]:s.offsets[i + 1]].split(b"\n") if x.strip()]
        out[i] = len(lines) - len(set(lines))
    return out


# Rules: True where a text is rejected.  ``base`` has the base figures; every text given has MIN_WORDS words at least.
def _symbols(s, base, which):
    """More than one symbol to ten words."""
    return 10 * base["n_symbols"][which] > base["n_words"][which]


def _lines(s, base, which):
    """More than three in ten lines with a word repeat an earlier line."""
    words, bounds = s.words_of(which)
    line = np.cumsum(s.flat == 0x0A)[s.first[words]]
    first = np.ones(len(words), np.int64)                        # the words that are the first of their line
    first[1:] = line[1:] != line[:-1]
    first[bounds[:-1][np.diff(bounds) > 0]] = 1
    return 10 * base["n_dup_lines"][which] > 3 * run_sums(first, bounds)


def _word_length(s, base, which):
    """Words of under 2 or over 20 characters on average."""
    chars, words = base["word_chars"][which], base["n_words"][which]
    return (chars < 2 * words) | (chars > 20 * words)


def _letterless(s, base, which):
    """Under seven in ten words have a letter."""
    words, bounds = s.words_of(which)
    total = np.concatenate([[0], np.cumsum(_LETTER[s.flat])])
    return 10 * run_sums((total[s.last[words]] > total[s.first[words]]).astype(np.int64), bounds) < 7 * np.diff(bounds)


def _shouting(s, base, which):
    """More than half of the words have A-Z and no a-z."""
    words, bounds = s.words_of(which)
    upper = np.concatenate([[0], np.cumsum(_UPPER[s.flat])])
    lower = np.concatenate([[0], np.cumsum(_LOWERED[s.flat])])
    a, b = s.first[words], s.last[words]
    return 2 * run_sums(((upper[b] > upper[a]) & (lower[b] == lower[a])).astype(np.int64), bounds) > np.diff(bounds)


def _stutter(s, base, which):
    """More than three in ten words equal the word before."""
    words, bounds = s.words_of(which)
    codes = s.codes()[words]
    same = np.zeros(len(words), np.int64)
    same[1:] = codes[1:] == codes[:-1]
    same[bounds[:-1][np.diff(bounds) > 0]] = 0
    return 10 * run_sums(same, bounds) > 3 * np.diff(bounds)


RULES: dict[str, Callable] = {"symbols": _symbols, "lines": _lines, "word_length": _word_length,
                              "letterless": _letterless, "shouting": _shouting, "stutter": _stutter}


class Cascade:
    """Rules of one task: all of them on the sample, then ordered by rejections per second."""

    def __init__(self, rules: dict[str, Callable], sample_texts: int):
        self.rules, self.order, self.left = rules, list(rules), sample_texts
        self.seconds = dict.fromkeys(rules, 0.0)
        self.rejected = dict.fromkeys(rules, 0)

    def run(self, s, base: dict[str, np.ndarray], alive: np.ndarray) -> np.ndarray:
        """The texts among alive that no rule rejects."""
        if self.left > 0:
            verdict = np.zeros(len(alive), bool)
            for name, rule in self.rules.items():
                began = time.perf_counter()
                bad = rule(s, base, alive)
                self.seconds[name] += time.perf_counter() - began
                self.rejected[name] += int(bad.sum())
                verdict |= bad
            self.left -= len(alive)
            self.order = sorted(self.rules, key=lambda r: -(self.rejected[r] + 1) / (self.seconds[r] + 1e-9))
            return alive[~verdict]
        for name in self.order:
            if not len(alive):
                break
            alive = alive[~self.rules[name](s, base, alive)]
        return alive


def base_figures(s: TextSlice) -> dict[str, np.ndarray]:
    return {"n_words": s.n_words, "word_chars": s.of_texts(_FIRST_BYTE[s.flat] & ~SPACE[s.flat]),
            "n_symbols": s.of_texts(SYMBOLS[s.flat]), "n_dup_lines": duplicate_lines(s),
            "n_repeat_words": repeated_words(s.codes(), s.words)}


def apply_rules(df: DataFrame, text_col: str, rules: dict[str, Callable] | None = None,
                sample_texts: int = 256) -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept."""
    rules = RULES if rules is None else rules

    def make():
        cascade = Cascade(rules, sample_texts)

        def compute(texts: pa.Array) -> list[np.ndarray]:
            s = TextSlice(texts)
            base = base_figures(s)
            failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > 30 * base["n_words"])
            kept = np.zeros(len(texts), bool)
            kept[cascade.run(s, base, np.flatnonzero(~failed))] = True
            return [*base.values(), failed, kept]

        return compute

    long = dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), T.LongType())
    return append_columns(df, text_col, {**long, "base_failed": T.BooleanType(), "kept": T.BooleanType()}, make)
