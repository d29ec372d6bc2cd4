"""Periodic runs of words, found by Crochemore's partition refinement.

At level l two positions are of one class when the factors of l words that begin there are equal. The classes of the next level follow
from which class the next position is in: where a class has been split, only its parts but the largest one are looked
at again, and the positions before them leave their classes (smaller half). A class is a chain of positions in order. Neighbours of a chain
at level l that are l apart begin a square of period l, whose root is primitive, as any shorter period would put a third
position between them; squares that begin at consecutive positions are one run.

A run of at least four periods in a text of n words has a period of n / 4 at most: chains are cut where neighbours are further apart
than that from the start, and levels end there. Texts of a batch are refined together, each behind a word that no other equals.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from . import textkernel as tk

#: Bytes of texts refined together, and those of a longer text whose words are hashed at once.
BATCH = 2_000_000
#: A level that moves at most so many positions is done without arrays.
FEW = 12


@dataclass
class Chains:
    """The classes of one level: of each position its class and its neighbours there (-1: none), of each class its size."""

    own: np.ndarray
    after: np.ndarray
    before: np.ndarray
    size: np.ndarray
    n: int
    limit: np.ndarray  # the longest period sought at each position, 0 behind a text
    due: dict[int, list] = field(default_factory=dict)  # level -> positions whose neighbour is as far away

    @classmethod
    def of(cls, words: np.ndarray, at: np.ndarray, periods: int) -> tuple[Chains, np.ndarray]:
        """The chains of equal words, and the positions of all classes but the largest of each text."""
        many = np.diff(at)
        total = len(words) + len(many)
        doc = np.repeat(np.arange(len(many)), many)
        place = np.arange(len(words)) + doc
        kind = np.int32 if total < 2**31 else np.int64
        limit = np.zeros(total, kind)
        limit[place] = np.repeat(many // periods, many)
        order = np.lexsort((words, doc))
        d, w, p = doc[order], words[order], place[order]
        apart = np.ones(len(p), bool)
        apart[1:] = (d[1:] != d[:-1]) | (w[1:] != w[:-1]) | (p[1:] - p[:-1] > limit[p[1:]])
        name = np.cumsum(apart) - 1
        classes = int(name[-1]) + 1 if len(name) else 0
        own = np.empty(total, kind)
        own[place[order]] = name
        ends = at[1:] + np.arange(len(many))
        own[ends] = classes + np.arange(len(many))
        size = np.zeros(total + 1, kind)
        size[:classes] = np.bincount(name, minlength=classes)
        size[classes : classes + len(many)] = 1
        after, before = np.full(total, -1, kind), np.full(total, -1, kind)
        joined = np.flatnonzero(~apart)
        after[p[joined - 1]], before[p[joined]] = p[joined], p[joined - 1]
        out = cls(own, after, before, size, classes + len(many), limit)
        out.expect(p[joined - 1], p[joined] - p[joined - 1], 1)
        first = np.flatnonzero(apart)
        largest = np.zeros(total + 1, bool)
        by = np.lexsort((-size[:classes], d[first]))
        largest[by[np.flatnonzero(np.diff(d[first][by], prepend=-1))]] = True
        return out, np.flatnonzero(~largest[own])

    def expect(self, position: np.ndarray, gap: np.ndarray, level: int) -> None:
        """Notes neighbours for the level that equals their distance."""
        useful = (gap >= level) & (gap <= self.limit[position])
        position, gap = position[useful], gap[useful]
        if not len(gap):
            return
        order = np.argsort(gap, kind="stable")
        position, gap = position[order], gap[order]
        cuts = np.flatnonzero(np.diff(gap, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(gap)], strict=True):
            self.due.setdefault(int(gap[a]), []).append(position[a:b])

    def squares(self, level: int) -> np.ndarray:
        """The positions, ascending, at which a square of this period begins."""
        noted = self.due.pop(level, None)
        if noted is None:
            return np.zeros(0, np.int64)
        p = np.unique(np.concatenate(noted)).astype(np.int64)
        return p[self.after[p] - p == level]

    def split(self, small: np.ndarray, level: int) -> np.ndarray:
        """Goes to the level by the parts split off last; gives the parts split off now, all but the largest of each class."""
        move = small[small > 0] - 1
        move = move[(self.size[self.own[move]] > 1) & (self.limit[move] >= level)]
        if len(move) <= FEW:
            return self._split_few(np.sort(move).tolist(), level)
        old, to = self.own[move].astype(np.int64), self.own[move + 1].astype(np.int64)
        order = np.lexsort((move, to, old))
        move, old, to = move[order], old[order], to[order]
        fresh = np.ones(len(move), bool)
        fresh[1:] = (old[1:] != old[:-1]) | (to[1:] != to[:-1])
        group = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        g_size, g_old = np.diff(np.append(first, len(move))), old[first]
        lead = np.flatnonzero(np.diff(g_old, prepend=-1))  # the first group of each class
        c_old, c_groups = g_old[lead], np.diff(np.append(lead, len(g_old)))
        rest = self.size[c_old] - np.add.reduceat(g_size, lead)
        # a class that goes on whole is not split
        splits = (rest > 0) | (c_groups > 1)
        if not splits.any():
            return np.zeros(0, np.int64)
        g_class = np.repeat(np.arange(len(c_old)), c_groups)
        keep = splits[g_class][group]
        move, group, old = move[keep], group[keep], old[keep]
        g_on = splits[g_class]
        by = np.lexsort((-g_size, g_class))  # the largest group of each class
        large = np.zeros(len(g_old), bool)
        large[by[np.flatnonzero(np.diff(g_class[by], prepend=-1))]] = True
        stays = large & (rest[g_class] == 0)  # takes the place of its class, of which nothing else is left
        moved = np.flatnonzero(g_on & ~stays)
        name = g_old.copy()
        name[moved] = self.n + np.arange(len(moved))
        # what stays in a class closes up around what leaves
        chain = np.lexsort((move, old))
        m = move[chain]
        linked = np.zeros(len(m), bool)
        linked[1:] = self.after[m[:-1]] == m[1:]
        heads = np.flatnonzero(~linked)
        left, right = self.before[m[heads]], self.after[m[np.append(heads[1:], len(m)) - 1]]
        seed_of = old[chain][heads]
        self.after[left[left >= 0]] = right[left >= 0]
        self.before[right[right >= 0]] = left[right >= 0]
        both = (left >= 0) & (right >= 0)
        self.expect(left[both].astype(np.int64), (right - left)[both], level)
        # the groups are chains of their own
        same = np.zeros(len(move), bool)
        same[1:] = group[1:] == group[:-1]
        at = np.flatnonzero(same)
        was = self.after[move].copy()
        self.after[move], self.before[move] = -1, -1
        self.after[move[at - 1]], self.before[move[at]] = move[at], move[at - 1]
        new = at[was[at - 1] != move[at]]
        self.expect(move[new - 1], move[new] - move[new - 1], level)
        self.own[move] = name[group]
        self.size[c_old[splits]] = np.where(rest > 0, rest, np.maximum.reduceat(g_size, lead))[splits]
        self.size[self.n : self.n + len(moved)] = g_size[moved]
        self.n += len(moved)
        most = np.maximum.reduceat(g_size, lead)
        # the largest part is not looked at again: the rest of a class, or a group, and then the rest is
        spared = large & (rest < most)[g_class]
        parts = [move[~spared[group]]]
        walk = splits & (rest > 0) & (rest < most)
        if walk.any():
            seed = np.full(len(c_old), -1, np.int64)
            c = np.searchsorted(c_old, seed_of)
            seed[c[right >= 0]] = right[right >= 0]
            seed[c[left >= 0]] = left[left >= 0]
            parts += [seed[walk], *self._walked(seed[walk], self.after), *self._walked(seed[walk], self.before)]
        return np.concatenate(parts).astype(np.int64)

    @staticmethod
    def _walked(cur: np.ndarray, link: np.ndarray) -> Iterator[np.ndarray]:
        while len(cur):
            cur = link[cur]
            cur = cur[cur >= 0]
            yield cur

    def _split_few(self, move: list[int], level: int) -> np.ndarray:
        """split for a handful of positions."""
        own, after, before = self.own, self.after, self.before
        classes: dict[int, dict[int, list[int]]] = {}
        for p in move:
            classes.setdefault(int(own[p]), {}).setdefault(int(own[p + 1]), []).append(p)
        small: list[int] = []
        for old, by in classes.items():
            groups = sorted(by.values(), key=len)
            rest = int(self.size[old]) - sum(map(len, groups))
            if not rest and len(groups) == 1:
                continue
            seed, changed = -1, []
            for p in sorted(p for g in groups for p in g):
                left, right = int(before[p]), int(after[p])
                if left >= 0:
                    after[left] = right
                if right >= 0:
                    before[right] = left
                if left >= 0 and right >= 0:
                    changed.append(left)
                seed = left if left >= 0 else right  # of the last one: stays
            for g in groups:
                for p in g:
                    after[p] = before[p] = -1
                for p, q in zip(g[:-1], g[1:], strict=True):
                    after[p], before[q] = q, p
                    changed.append(p)
            for p in changed:
                if level <= (gap := int(after[p]) - p) <= self.limit[p]:
                    self.due.setdefault(gap, []).append(np.asarray([p]))
            for g in groups if rest else groups[:-1]:
                self.size[self.n] = len(g)
                own[g] = self.n
                self.n += 1
            self.size[old] = rest or len(groups[-1])
            small += [p for g in groups[:-1] for p in g]
            if rest >= len(groups[-1]):
                small += groups[-1]
            elif rest:
                small.append(seed)
                for link in (after, before):
                    p = int(link[seed])
                    while p >= 0:
                        small.append(p)
                        p = int(link[p])
        return np.asarray(small, np.int64)


def runs(words: np.ndarray, at: np.ndarray, periods: int = 4, least: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run of at least periods periods and least words, by text, start and period.

    words are numbers of words, those of text k at at[k] to at[k + 1]. An empty text has no runs."""
    found: list[tuple[np.ndarray, np.ndarray, int]] = []
    if len(words):
        chains, small = Chains.of(words, at, periods)
        last, level = int(chains.limit.max()), 1
        while level <= last:
            p = chains.squares(level)
            if len(p):
                begin = np.flatnonzero(np.diff(p, prepend=-2) != 1)
                squares = np.diff(np.append(begin, len(p)))
                length = squares - 1 + 2 * level
                long = (length >= periods * level) & (length >= least)
                if long.any():
                    found.append((p[begin[long]], length[long], level))
            level += 1
            small = chains.split(small, level)
            if not len(small):
                break  # nothing is left but single positions
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    start, length = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    period = np.repeat([f[2] for f in found], [len(f[0]) for f in found])
    text = np.searchsorted(at[:-1] + np.arange(len(at) - 1), start, "right") - 1
    start = start - at[text] - text
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts and ends of words, their hashes, where each row's begin): runs of whole texts, a long one alone."""
    raw, off = tk.buffers(texts)
    held: list[tuple] = []
    for a, b, part, part_off, before, ends_here in tk.windows(texts, BATCH):
        starts, ends, many = tk.word_spans(part, part_off)
        held.append((starts + before, ends + before, tk.word_hashes(part, starts, ends, tk.EXACT), many))
        if ends_here:
            starts, ends, h, many = (np.concatenate(x) for x in zip(*held, strict=True)) if len(held) > 1 else held[0]
            at = np.concatenate(([0], np.cumsum(many))) if len(held) == 1 else np.asarray([0, len(h)])
            held = []
            yield a, b, raw[off[a] : off[b]], starts, ends, h, at


def _sources(n: int, doc_id: int | None) -> np.ndarray | None:
    """For a text whose tail is to be made periodic, the word that stands at each place."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def _joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> str:
    """The digest of the words kept, one space between them."""
    out, data = hashlib.sha256(), memoryview(raw)
    for a in range(0, len(kept), 50_000):
        k = kept[a : a + 50_000]
        out.update(b" " * (a > 0) + b" ".join([bytes(data[x:y]) for x, y in zip(starts[k].tolist(), ends[k].tolist(), strict=True)]))
    return out.hexdigest()


def _reported(batches: Iterator[pa.RecordBatch], tails: bool, periods: int, least: int) -> Iterator[pa.RecordBatch]:
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "starts", "lengths", "periods"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        ids = batch.column("_id").to_pylist()
        for a, b, raw, starts, ends, h, at in _words(batch.column("_text")):
            made = [_sources(int(at[k + 1] - at[k]), ids[a + k]) if tails else None for k in range(b - a)]
            for k, src in enumerate(made):
                if src is not None:
                    h[at[k] : at[k + 1]] = h[at[k] + src]
            text, start, length, period = runs(h, at, periods, least)
            bounds = np.searchsorted(text, np.arange(b - a + 1))
            for k in range(b - a):
                x, y = int(bounds[k]), int(bounds[k + 1])
                n, src = int(at[k + 1] - at[k]), made[k]
                s, l, q = start[x:y].tolist(), length[x:y].tolist(), period[x:y].tolist()
                kept = np.ones(n, bool)
                best = None
                for run in zip(s, l, q, strict=True):
                    kept[run[0] + run[2] : run[0] + run[1]] = False
                    # by start and period: of equal exponents the first stays
                    if best is None or run[1] * best[2] > best[1] * run[2]:
                        best = run
                places = np.flatnonzero(kept)
                report = hashlib.sha256("".join(f"{i},{j},{p}\n" for i, j, p in zip(s, l, q, strict=True)).encode()).hexdigest()
                digest = _joined(raw, starts[at[k] : at[k + 1]], ends[at[k] : at[k + 1]], places if src is None else src[places])
                row = [y - x, *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, report, digest, s, l, q]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([*batch.columns[2:], *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))], names=[*batch.schema.names[2:], *names])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), periods: int = 4, least: int = 6, tails: bool = False) -> DataFrame:
    """The columns keep of docs with all runs of words of each text (starts, lengths and periods, by start and period), the strongest of them,
    and digests of the runs and of the text without what repeats.

    A run is a longest stretch of at least least words and periods times its smallest period. A null or empty text has none, and the digest of nothing. Rows that
    repeat an id are texts of their own; an empty table gives no rows. The columns of the result must differ from those of keep; other
    columns are not read. With tails, texts whose id has a checksum divisible by 10 first get a periodic tail, as the contract of the query says; those of a null id
    stay. A text is one row of one task, some 200 bytes a word; its words are found in windows."""
    shared.ship(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"), *keep)
    added = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, starts array<long>, lengths array<long>, periods array<long>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields), added])
    return given.mapInArrow(lambda it: _reported(it, tails, periods, least), schema)


def op13_word_runs(spark, sf_dir):
    """The periodic runs of every document, with tails as the contract has them."""
    docs = shared.table(spark, sf_dir, "documents")
    return periodic_runs(docs, keep=("doc_id",), tails=True).drop("starts", "lengths", "periods")


QUERIES = {"op13_word_runs": op13_word_runs}
ORACLES: dict[str, str] = {}
