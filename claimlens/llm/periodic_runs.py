"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbouring word extends, of at
least max(``least_words``, ``least_periods`` * q) words.

Method.  The suffix automaton of a stretch gives the tree of its suffix links.  Words are then appended one by one: the
path from the newest prefix's state to the root is accessed in a link-cut tree whose preferred paths carry one colour
each, the place where their words last ended.  Each path segment met on the way, with last end j and longest word of
length L, says that the last L words also ended at j; if i - j <= L they hold a square of period i - j.  The access
recolours the whole path to i.  A square that no known run of its period holds is extended both ways to a run.  The
first square of every run is met so, and its distance is the run's smallest period, as the words of a square with a
smaller period would have ended later.

Where no run can be, no automaton is built: in a run of period q every three words after the first q + 2 have been seen
q words before, so a run lies in a stretch of consecutive repeated triples with at least 3 q - 2 of them, and some of
these repeat at distance q or less.  Triples are compared by a hash; a collision only adds a stretch to look at.

Texts: null ones have no words.  Rows are taken as they come (repeated rows, null ids); an empty table gives no row;
names that clash get underscores.  Very long texts are one slice; memory follows the longest stretch (about 1 KB for
each of its words).  Ties of the strongest run: smallest start, then period.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import arrow_schema, free_name, mix64, row_slices, ship_package, text_bytes, texts_of

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(length of each state's longest word, suffix links, state of each prefix); state 0 is the empty word."""
    length, link, step, ends, last = [0], [-1], [{}], [], 0
    for c in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        step.append({})
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                step.append(step[q].copy())
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        ends.append(new)
        last = new
    return length, link, ends


class PathColours:
    """Link-cut tree over a fixed tree; every preferred path has one colour, kept at the root of its splay tree.

    Nodes are numbered from 1 (0: none).
    """

    def __init__(self, parents: list[int]):
        self.parent = [0] + [p + 1 for p in parents]
        self.left = [0] * len(self.parent)
        self.right = [0] * len(self.parent)
        self.colour = [-1] * len(self.parent)

    def _rotate(self, x: int) -> None:
        parent, left, right = self.parent, self.left, self.right
        y = parent[x]
        z = parent[y]
        if z and left[z] == y:
            left[z] = x
        elif z and right[z] == y:
            right[z] = x
        else:
            self.colour[x] = self.colour[y]                       # y was the root of its splay tree
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            parent[b] = y
        parent[y] = x
        parent[x] = z

    def _splay(self, x: int) -> None:
        parent, left, right = self.parent, self.left, self.right
        while True:
            y = parent[x]
            if not y or left[y] != x and right[y] != x:
                return
            z = parent[y]
            if z and (left[z] == y or right[z] == y):
                self._rotate(y if (left[y] == x) == (left[z] == y) else x)
            self._rotate(x)

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """(lowest node on the path, colour) of each segment from node to the root, which then all get ``colour``."""
        met, below, x = [], 0, node + 1
        while x:
            self._splay(x)
            old, cut = self.colour[x], self.right[x]
            if cut:
                self.colour[cut] = old
            if old >= 0:
                met.append((x - 1, old))
            self.right[x] = below
            below, x = x, self.parent[x]
        self.colour[below] = colour
        return met


def runs_of(words: list[int], longest_period: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of two periods or more, by place of its first square."""
    n = len(words)
    longest_period = n if longest_period is None else longest_period
    length, link, ends = automaton(words)
    paths, known, runs = PathColours(link), {}, []
    for i, state in enumerate(ends):
        for node, before in paths.access(state, i):
            d = i - before
            if d > length[node] or d > longest_period or known.get(d, -1) >= i:
                continue
            start, end = i - length[node] - d + 1, i
            while start and words[start - 1] == words[start - 1 + d]:
                start -= 1
            while end + 1 < n and words[end + 1] == words[end + 1 - d]:
                end += 1
            known[d] = end
            runs.append((start, end - start + 1, d))
    return runs


def stretches(codes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, first, last, longest period) of the stretches of repeated triples that can hold a run's end.

    ``codes`` are the words of all texts, text k from ``first[k]`` to ``first[k + 1]``; places are counted over all.
    """
    n = len(codes)
    if n < 3:
        return
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    c = codes.astype(np.uint64)
    key = mix64(c[2:] + mix64(c[1:-1] + mix64(c[:-2] + mix64(text[2:].astype(np.uint64)))))
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    apart = np.zeros(n + 1, np.int64)                             # to the same three words before; 0: none
    apart[order[same + 1] + 2] = order[same + 1] - order[same]
    starts = first[:-1][first[:-1] < n]
    apart[starts] = apart[starts + 1] = 0                         # no three words yet
    again = apart > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], again]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]                          # [begin, end)
    size = end - begin
    fine = size >= 3
    begin, end, size = begin[fine], end[fine], size[fine]
    if len(begin):
        nearest = np.minimum.reduceat(apart, np.stack([begin, end], 1).ravel())[::2]
        for k in np.flatnonzero(3 * nearest - 2 <= size).tolist():
            yield int(text[begin[k]]), int(begin[k]), int(end[k]) - 1, (int(size[k]) + 2) // 3


def find_runs(texts: list[list[bytes]], least_words: int = 6, least_periods: int = 4) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words, by start, then period."""
    if least_words < 6 or least_periods < 4:
        raise ValueError("stretches are certain for runs of at least six words and four periods")
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    first = np.concatenate([[0], np.cumsum([len(w) for w in texts], dtype=np.int64)]).astype(np.int64)
    codes = np.empty(first[-1], np.int64)
    for words, a, b in zip(texts, first[:-1], first[1:]):
        codes[a:b] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, a, b, longest in stretches(codes, first):
        low = max(int(first[k]), a - 2 - longest)
        for start, length, period in runs_of(codes[low:b + 1].tolist(), longest):
            if length >= max(least_words, least_periods * period) and low + start + period + 2 >= a:
                found[k].append((low + start - int(first[k]), length, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, exactly; the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep).tolist()])


def periodic_runs(df: DataFrame, id_col: str, text_col: str, least_words: int = 6, least_periods: int = 4,
                  prepare: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """df without its text, with n_words, runs (start, length, period), strongest and collapsed (the text without repeats).

    ``prepare(id, words)`` may change a text's words before runs are looked for.
    """
    ship_package(df.sparkSession)
    rest = [c for c in df.columns if c != text_col]
    bare = df.drop(text_col)
    made = {"n_words": T.LongType(), "runs": T.ArrayType(RUN), "strongest": RUN, "collapsed": T.StringType()}
    schema = T.StructType([*bare.schema.fields, *(T.StructField(free_name(bare, k), t) for k, t in made.items())])
    target = arrow_schema(schema)
    at, ids_at, kept = df.columns.index(text_col), df.columns.index(id_col), [df.columns.index(c) for c in rest]
    names = ("start", "length", "period")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts_of(batch.column(at))
            for begin, n in row_slices(column):
                flat, offsets = text_bytes(column.slice(begin, n))
                data = flat.tobytes()
                texts = [data[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                if prepare is not None:
                    texts = [prepare(i, w) for i, w in zip(batch.column(ids_at).slice(begin, n).to_pylist(), texts)]
                runs = find_runs(texts, least_words, least_periods)
                best = [strongest(r) for r in runs]
                columns = [[len(w) for w in texts], [[dict(zip(names, r)) for r in rs] for rs in runs],
                           [None if r is None else dict(zip(names, r)) for r in best],
                           pa.array([collapse(w, r) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(begin, n) for k in kept]
                    + [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, list(target)[len(rest):])],
                    schema=target)

    return df.mapInArrow(run, schema)
