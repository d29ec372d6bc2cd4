"""Language-model scoring by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts up to ``order`` with the count of each following byte. A byte that its longest
known context has not seen escapes to the next shorter one (method C: the escape weighs as many counts as
the context has followers), where the bytes that the longer context has seen are excluded; what
no context has seen is uniform among the bytes left. Every follower of a context also follows its suffix, so
what exclusion takes away is a number of each context, and the pretrained model is a set of sorted
arrays that scores whole batches. Texts are read in windows of WINDOW bytes, long ones in several, so that
a batch takes the same memory whatever its texts are.

Learning counts (order + 1)-grams of bytes over all training texts in each partition, and sums these in a shuffle. The
order is the same whatever the corpus, so the trie grows with it and stays in partitions. Executors hold the
probabilities of its frequent grams, each at least a 2^24th of all and 2^21 at most; a text's other grams go
to the buckets of the trie by their three last bytes of context: all longer contexts that end so are
there, and those of up to two bytes, whose grams number 2^24 at most, are everywhere.

A text is the UTF-8 bytes of its A-Z-lowered characters and an end mark, byte 0xFF, which also stands before the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared
from . import textkernel as tk

END = 0xFF
WINDOW = 400_000
#: An empty slot: grams have seven bytes at most.
FREE = np.uint64(2**64 - 1)
#: The end of a text as a token, beside the hashes of words.
END_TOKEN = -(2**63) + 1


class Trie:
    """A PPM model that learns as it reads: the plain form, byte by byte."""

    def __init__(self, order: int = 4):
        self.order, self.counts = order, {}

    def learn(self, context: bytes, byte: int) -> None:
        for k in range(self.order + 1):
            followers = self.counts.setdefault(context[len(context) - k :], {})
            followers[byte] = followers.get(byte, 0) + 1

    def log10(self, context: bytes, byte: int) -> float:
        """log10 of the probability of byte after context (of order bytes)."""
        total, excluded = 0.0, set()
        for k in range(self.order, -1, -1):
            followers = {b: n for b, n in self.counts.get(context[len(context) - k :], {}).items() if b not in excluded}
            if not followers:
                continue
            weight = sum(followers.values()) + len(followers)
            if byte in followers:
                return total + math.log10(followers[byte] / weight)
            total += math.log10(len(followers) / weight)
            excluded |= followers.keys()
        return total - math.log10(256 - len(excluded))

    def steps(self, text: str) -> Iterator[tuple[bytes, int]]:
        data = bytes([END] * self.order) + tk.LOWER[np.frombuffer(text.encode(), np.uint8)].tobytes() + bytes([END])
        for i in range(self.order, len(data)):
            yield data[i - self.order : i], data[i]

    def adaptive(self, text: str) -> float:
        """log10 of the probability of a text under the model that learns each byte after it is coded."""
        total = 0.0
        for context, byte in self.steps(text):
            total += self.log10(context, byte)
            self.learn(context, byte)
        return total


@dataclass
class Model:
    """The pretrained trie. For each k: grams of k + 1 bytes and their counts, contexts of k bytes with
    the sum of their counts and the number of their followers; for k > 0 what remains of the suffix's."""

    order: int
    grams: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    total: list[np.ndarray] = field(default_factory=list)
    followers: list[np.ndarray] = field(default_factory=list)
    left: list[np.ndarray] = field(default_factory=list)
    left_followers: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def of(grams: np.ndarray, counts: np.ndarray, order: int, base: Model | None = None) -> Model:
        """From distinct grams of order + 1 bytes, the first byte highest, and their counts.

        A base gives the levels up to its own order; the grams then need only be all those of their contexts of more bytes."""
        if base and base.order >= order:
            return base
        at = np.argsort(grams)
        least = base.order + 1 if base else 0
        levels = [(grams[at], counts[at].astype(np.int64))]
        for k in range(order - 1, least - 1, -1):
            g, inverse = np.unique(levels[-1][0] & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
            levels.append((g, np.bincount(inverse, levels[-1][1], len(g)).astype(np.int64)))
        m = Model(order, *(list(getattr(base, f)) if base else [] for f in ("grams", "counts", "contexts", "total", "followers", "left", "left_followers")))
        for k, (g, n) in enumerate(reversed(levels), least):
            ctx = g >> np.uint64(8)
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(g)), bool), ctx[1:] != ctx[:-1])))
            add = lambda x: np.add.reduceat(x, first) if len(first) else np.zeros(0, np.int64)  # noqa: B023, E731
            m.grams.append(g)
            m.counts.append(n)
            m.contexts.append(ctx[first])
            m.total.append(add(n))
            m.followers.append(add(np.ones(len(g), np.int64)))
            if k:
                low = (1 << (8 * k)) - 1
                seen = add(m.counts[k - 1][np.searchsorted(m.grams[k - 1], g & np.uint64(low))])
                suffix = np.searchsorted(m.contexts[k - 1], ctx[first] & np.uint64(low >> 8))
                m.left_followers.append(m.followers[k - 1][suffix] - m.followers[k])
                m.left.append(m.total[k - 1][suffix] - seen + m.left_followers[-1])
            else:
                m.left.append(np.zeros(0, np.int64))
                m.left_followers.append(np.zeros(0, np.int64))
        return m

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last byte of each gram after the others."""
        out, open_, above = np.zeros(len(grams)), np.arange(len(grams)), np.full(len(grams), -1)
        for k in range(self.order, -1, -1):
            g = grams[open_] & np.uint64((1 << (8 * (k + 1))) - 1)
            node, known = _find(self.contexts[k], g >> np.uint64(8))
            gram, seen = _find(self.grams[k], g)
            weight, escape = np.zeros(len(g)), np.zeros(len(g))
            fresh = known & (above[open_] < 0)
            weight[fresh] = (self.total[k] + self.followers[k])[node[fresh]]
            escape[fresh] = self.followers[k][node[fresh]]
            if k < self.order:
                down = above[open_] >= 0
                weight[down] = self.left[k + 1][above[open_][down]]
                escape[down] = self.left_followers[k + 1][above[open_][down]]
            done = seen & (weight > 0)
            out[open_[done]] += np.log10(self.counts[k][gram[done]] / weight[done])
            on = ~done & (weight > 0)
            out[open_[on]] += np.log10(escape[on] / weight[on])
            above[open_[known]] = node[known]
            open_ = open_[~done]
        root = int(self.followers[0][0]) if len(self.followers[0]) else 0
        out[open_] -= math.log10(max(256 - root, 1))
        return out


def _find(where: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(where, keys), max(len(where) - 1, 0))
    return at, where[at] == keys if len(where) else np.zeros(len(keys), bool)


@dataclass
class Often:
    """The frequent grams and log10 of their probabilities in an open-addressing table that is two thirds full."""

    #: (key, value): both are read at once
    cells: np.ndarray

    @staticmethod
    def of(grams: np.ndarray, logs: np.ndarray) -> Often:
        size = max(16, len(grams) * 3 // 2)
        cells = np.zeros(size, [("key", np.uint64), ("value", np.float64)])
        keys, values = cells["key"], cells["value"]
        keys[:] = FREE
        todo, slot = np.arange(len(grams)), _slots(grams, size)
        while len(todo):
            free = keys[slot] == FREE
            _, pick = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[pick]
            keys[slot[won]], values[slot[won]] = grams[todo[won]], logs[todo[won]]
            rest = np.ones(len(todo), bool)
            rest[won] = False
            todo, slot = todo[rest], (slot[rest] + 1) % size
        return Often(cells)

    def log10(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 of the probability of each gram or 0, places of the grams that are not frequent)."""
        size, slot = len(self.cells), _slots(grams, len(self.cells))
        met = self.cells.take(slot)
        out = met["value"].copy()
        wrong = np.flatnonzero(met["key"] != grams)
        key = met["key"][wrong]
        missing = [np.zeros(0, np.int64)]
        slot = slot[wrong]
        while len(wrong):
            empty = key == FREE
            missing.append(wrong[empty])
            wrong, slot = wrong[~empty], (slot[~empty] + 1) % size
            met = self.cells.take(slot)
            hit = met["key"] == grams[wrong]
            out[wrong[hit]] = met["value"][hit]
            wrong, slot, key = wrong[~hit], slot[~hit], met["key"][~hit]
        missing = np.concatenate(missing)
        out[missing] = 0
        return out, missing


@dataclass
class Trained:
    """The trie of a corpus: its contexts of up to two bytes, its frequent grams, and all its grams (bucket, key, n)."""

    order: int
    base: Model
    often: Often
    grams: DataFrame
    buckets: int


def _slots(grams: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def text_grams(raw: np.ndarray, off: np.ndarray, order: int, lead: bytes = b"", ended: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(gram of order + 1 bytes that ends at each byte or end mark, document of each).

    lead are lowered bytes of the first document that come before raw; without ended the last document goes on."""
    n, marks = len(off) - 1, len(off) - 2 + ended
    doc = np.repeat(np.arange(n), np.diff(off) + 1)[: len(raw) + marks]
    data = np.full(len(raw) + marks, END, np.uint8)
    inside = np.ones(len(data), bool)
    inside[(off[1:] + np.arange(n))[:marks]] = False
    data[inside] = tk.LOWER[raw]
    data = np.concatenate((np.full(7 - len(lead), END, np.uint8), np.frombuffer(lead, np.uint8), data))
    grams = np.ndarray(len(data) - 7, ">u8", data, strides=(1,)).astype(np.uint64) & np.uint64((1 << (8 * (order + 1))) - 1)
    for j in range(order):  # before the later documents' bytes come marks; the first has its lead
        at = off[1:-1] + np.arange(1, n) + j
        at = at[(at <= off[2:] + np.arange(1, n)) & (at < len(grams))]
        grams[at] |= np.uint64(sum(END << (8 * k) for k in range(j + 1, order + 1)))
    return grams, doc


def _windows(texts: pa.Array, order: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bytes, bool]]:
    """(first row, end row, bytes, offsets, lead, ended) of windows of texts."""
    lead = b""
    for a, b, raw, off, before, ended in tk.windows(texts, WINDOW):
        yield a, b, raw, off, lead if before else b"", ended
        lead = ((lead if before else b"") + tk.LOWER[raw[-order:]].tobytes())[-order:] if order else b""


def _tally(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    keys, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return [(keys[first], np.add.reduceat(n, first) if len(first) else n)]


def _counted(batches: Iterator[pa.RecordBatch], order: int, flush: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """(kind, key, n): grams are of kind 0, tokens of kind 1; a partition's counts, in parts if they grow large."""
    held: list[list] = [[], []]

    def out(kind: int) -> Iterator[pa.RecordBatch]:
        for keys, n in held[kind]:
            for a in range(0, len(keys), 100_000):
                part = keys[a : a + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part), pa.array(n[a : a + 100_000])], names=["kind", "key", "n"])
        held[kind] = []

    for batch in batches:
        for _, _, raw, off, lead, ended in _windows(batch.column(0), order):
            starts, ends, _ = tk.word_spans(raw, off)
            words = np.concatenate((tk.word_hashes(raw, starts, ends), np.full(len(off) - 2 + ended, END_TOKEN, np.int64).view(np.uint64)))
            for kind, keys in enumerate((text_grams(raw, off, order, lead, ended)[0], words)):
                held[kind].append(np.unique(keys, return_counts=True))
                if sum(len(k) for k, _ in held[kind]) > flush:
                    held[kind] = _tally(held[kind])
                    if len(held[kind][0][0]) > flush // 2:
                        yield from out(kind)
    for kind in (0, 1):
        if held[kind]:
            held[kind] = _tally(held[kind])
        yield from out(kind)


@dataclass
class Words:
    """The corpus's sums and the log10(c + 1) of its most frequent tokens, which number 2^20 at most."""

    total: int
    distinct: int
    keys: np.ndarray
    logs: np.ndarray


def _bucket(buckets: int) -> Column:
    """The bucket of a key's three bytes before the last."""
    return F.pmod(F.xxhash64(F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << 24) - 1))), F.lit(buckets))


def _suffixes(grams: DataFrame, order: int) -> DataFrame:
    return grams.groupBy(F.col("key").bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1)).alias("key")).agg(F.sum("n").alias("n"))


def learn(texts: DataFrame, text_col: str = "text", order: int = 6, most_grams: int | None = None, often: int = 1 << 24, most_often: int = 1 << 21, bucket_grams: int = 20_000) -> tuple[Trained, Words, DataFrame]:
    """(trie, word sums, counts of all tokens) of all rows of texts.

    Grams of at least one in ``often`` of all are frequent; where these are over ``most_often``, fewer are. The order is fixed unless a caller asks for a trie of ``most_grams`` at most."""
    if not 0 < order <= 6:
        raise ValueError(f"order is {order}; a gram holds contexts of one to six bytes")
    shared.ship(texts.sparkSession)
    counts = texts.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(lambda it: _counted(it, order), "kind int, key long, n long")
    counts = shared.saved(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")))
    grams = counts.where("kind = 0").select("key", "n")
    all_grams = grams.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    distinct = all_grams["v"]
    while most_grams is not None and order > 2 and distinct > most_grams:
        order -= 1
        grams = shared.saved(_suffixes(grams, order))
        distinct = grams.count()
    least = min(order, 2)
    table = _suffixes(grams, least).toArrow()
    base = Model.of(table["key"].to_numpy().view(np.uint64), table["n"].to_numpy(), least)
    ctx = F.shiftrightunsigned("key", 8)
    weights = grams.groupBy(ctx.alias("ctx")).agg((F.sum("n") + F.count("*")).alias("weight"))
    frequent = lambda: grams.where(F.col("n") * F.lit(float(often)) >= F.lit(float(all_grams["n"])))
    while often > most_often and frequent().count() > most_often:
        often //= 2
    table = frequent().withColumn("ctx", ctx).join(weights, "ctx").select("key", F.log10(F.col("n") / F.col("weight")).alias("log")).toArrow()
    buckets = -(-max(distinct, 1) // bucket_grams)
    trained = Trained(order, base, Often.of(table["key"].to_numpy().view(np.uint64), table["log"].to_numpy()), grams.select(_bucket(buckets).alias("bucket"), "key", "n"), buckets)
    tokens = counts.where("kind = 1").select("key", "n")
    sums = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    words = tokens.where(F.col("n") * F.lit(float(1 << 20)) >= F.lit(float(sums["n"]))).toArrow()  # each has a 2^20th of all tokens
    keys, n = words["key"].to_numpy().view(np.uint64), words["n"].to_numpy()
    at = np.argsort(keys)
    return trained, Words(sums["n"], sums["v"], keys[at], np.log10(n[at] + 1.0)), tokens


def _lists(keys: np.ndarray, doc: np.ndarray, n_docs: int) -> pa.ListArray:
    by = np.argsort(doc, kind="stable")
    ends = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n_docs)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[by].view(np.int64)))


def _scored(batches: Iterator[pa.RecordBatch], order: int, often: Often, words: Words) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: list = []  # the windows of a document that goes on: sums, and what is asked for
        for a, b, raw, off, lead, ended in _windows(batch.column("_text"), order):
            n_docs = b - a
            grams, doc = text_grams(raw, off, order, lead, ended)
            found, seldom = often.log10(grams)
            score = np.bincount(doc, found, n_docs)
            starts, ends, n_words = tk.word_spans(raw, off)
            h, own = tk.word_hashes(raw, starts, ends), np.repeat(np.arange(n_docs), n_words)
            if ended:
                h, own = np.concatenate((h, np.full(n_docs, END_TOKEN, np.int64).view(np.uint64))), np.concatenate((own, np.arange(n_docs)))
            at, known = _find(words.keys, h)
            logs = np.bincount(own[known], words.logs[at[known]], n_docs) if len(words.keys) else np.zeros(n_docs)
            sums, asked = [n_words + ended, np.bincount(own[known], minlength=n_docs), logs, score], [(h[~known], own[~known]), (grams[seldom], doc[seldom])]
            if not ended:
                held.append((sums, asked))
                continue
            for more, parts in held:
                sums = [x + y for x, y in zip(sums, more, strict=True)]
                asked = [tuple(map(np.concatenate, zip(x, y, strict=True))) for x, y in zip(parts, asked, strict=True)]
            held = []
            part = batch.slice(a, n_docs)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *map(pa.array, sums), *(_lists(k, o, n_docs) for k, o in asked)], names=["id", "held_out", "n_tokens", "n_often", "logs", "score", "rare", "grams"])


def _looked_up(batches: Iterator[pa.RecordBatch], order: int, base: Model) -> Iterator[pa.RecordBatch]:
    """(row, log): sums for the grams of texts. Rows come by bucket and row; those of the trie, of row -1, are a bucket's first."""
    now, held, model = None, [], None
    for batch in batches:
        bucket, row, key, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        cuts = np.flatnonzero(np.concatenate((np.ones(min(1, len(bucket)), bool), bucket[1:] != bucket[:-1])))
        for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
            if bucket[a] != now:
                now, held, model = bucket[a], [(np.zeros(0, np.int64), np.zeros(0, np.int64))], None
            c = a + int(np.searchsorted(row[a:b], 0))
            if c > a:
                held.append((key[a:c], n[a:c]))
            if c == b:
                continue
            if model is None:
                model = Model.of(*(np.concatenate(x) for x in zip(*((k.view(np.uint64), m) for k, m in held), strict=True)), order, base)
            odd, inverse = np.unique(key[c:b].view(np.uint64), return_inverse=True)
            own = row[c:b]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            yield pa.RecordBatch.from_arrays([pa.array(own[first]), pa.array(np.add.reduceat(model.log10(odd)[inverse], first))], names=["row", "log"])


def score(docs: DataFrame, model: Trained, words: Words, tokens: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    A null or empty text is its end mark alone. Rows that repeat an id or a text are scored each; a null id is kept. A model of no
    texts knows no byte, and gives each 1 in 256. Other columns of docs, of whatever names, are not read. A text of any length is read in
    windows; only its rare words and seldom grams, 8 bytes each, are held together."""
    shared.ship(docs.sparkSession)
    context, order = docs.sparkSession.sparkContext, model.order
    held, base = context.broadcast((model.often, words)), context.broadcast(model.base)
    source = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    kind = dict(source.dtypes)["id"]
    first = shared.saved(source.mapInArrow(lambda it: _scored(it, order, *held.value), f"id {kind}, held_out boolean, n_tokens long, n_often long, logs double, score double, rare array<long>, grams array<long>"))
    first = first.withColumn("row", F.monotonically_increasing_id())  # fixed, as first is stored
    seldom = tokens.where(F.col("n") * F.lit(float(1 << 20)) < F.lit(float(words.total)))
    found = first.select("row", F.explode("rare").alias("key")).join(seldom, "key").groupBy("row").agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("n") + 1.0)).alias("rare_logs"))
    none = F.lit(0).cast("long")
    asked = first.select("row", F.explode("grams").alias("key")).select(_bucket(model.buckets).alias("bucket"), "row", "key", none.alias("n"))
    both = asked.union(model.grams.select("bucket", F.lit(-1).cast("long").alias("row"), "key", "n"))
    # whole buckets meet in a task, one at a time
    looked_up = both.repartition("bucket").sortWithinPartitions("bucket", "row").mapInArrow(lambda it: _looked_up(it, order, base.value), "row long, log double")
    out = first.drop("rare", "grams").join(found, "row", "left").join(looked_up.groupBy("row").agg(F.sum("log").alias("gram_logs")), "row", "left")
    return out.select(
        "id", "held_out", "n_tokens", (F.col("n_often") + F.coalesce("n_rare", none)).alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(words.total + words.distinct + 1))).alias("base_score"),
        (F.col("score") + F.coalesce("gram_logs", F.lit(0.0))).alias("score"),
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the checksum of the id as text leaves 2 when divided by 7; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 7 == 2, F.lit(False))


def op1_ppm_scoring(spark, sf_dir):
    """Every document's log10 probability under the trie of the documents that are not held out."""
    docs = shared.table(spark, sf_dir, "documents")
    return score(docs, *learn(docs.where(~held_out())), held_out()).withColumnRenamed("id", "doc_id")


QUERIES = {"op1_ppm_scoring": op1_ppm_scoring}
ORACLES: dict[str, str] = {}
