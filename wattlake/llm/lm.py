"""Class-conditional Kneser-Ney models over characters, in hashed tables that numpy can gather from.

Each class has its own counts from order ``own`` upwards; the orders below are shared by the classes,
so an expression that one class has never seen falls back to the same estimate as in the others.
Counts below the highest order are continuation counts, as in interpolated Kneser-Ney. A table is an
array of counts addressed by a hash of the n-gram; its size is fixed by ``bits``, so a model has a
bounded size whatever it was fitted on. The counts of a class that is a whole corpus are made in Spark
(``corpus_tables``): only the filled places of the tables come to the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattlake.session import cut_lineage

DISCOUNT = 0.75
_PAD = "\x02"


def coded(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts in one array, each text after ``order`` marks, and the text of each position (-1 at marks)."""
    pad = _PAD * order
    c = np.frombuffer("".join(pad + t for t in texts).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    n = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    owner = np.repeat(np.arange(len(texts)), n + order)
    start = np.repeat(np.cumsum(n + order) - (n + order), n + order)
    owner[np.arange(len(owner)) - start < order] = -1
    return c, owner


def _mixed(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The hash of a gram that is longer by one older character."""
    with np.errstate(over="ignore"):
        h = (h ^ (c + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return h


def _each_order(c: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """The hashes of ``grams`` for k = 1..order, one after the other."""
    h = np.full(len(c), 7, dtype=np.uint64)
    moved = c.copy()
    for _ in range(order):
        h = _mixed(h, moved)
        yield h
        moved[1:] = moved[:-1].copy()
        moved[0] = 0


def _key(c: np.ndarray, order: int) -> np.ndarray:
    """A cheaper hash of the ``order`` characters that end at each position, for the memo only."""
    with np.errstate(over="ignore"):
        h, factor = c.copy(), 1
        for k in range(1, order):
            factor = factor * 0xD1342543DE82EF95 & (1 << 64) - 1
            h[k:] += c[:-k] * np.uint64(factor)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def grams(c: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 0..order a hash of the k characters that end at each position."""
    return [np.full(len(c), 7, dtype=np.uint64), *_each_order(c, order)]


def pieces(texts: list[str], chars: int = 150_000) -> Iterator[tuple[int, int]]:
    """Ranges of the list of about ``chars`` characters, to bound what is coded at once."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


#: Bits of a character in a packed n-gram, three of them a word.
_BITS = 21

#: Places of a worker's memos: of the n-grams it counts, and of the gains of those seen last.
MEMO = 1 << 20

#: The filled places of a table and what stands there.
Sparse = tuple[np.ndarray, np.ndarray]


def _sparse(t: np.ndarray) -> Sparse:
    at = np.flatnonzero(t)
    return at.astype(np.uint32), t[at].astype(np.float32)


def _packed(c: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``order`` characters that end at some positions in two words, the newest highest, so that grams sort by their ends."""
    words = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for j in range(order):
        words[j // 3][:] |= c[at - j] << np.uint64(_BITS * (2 - j % 3))
    return words[0].astype(np.int64), words[1].astype(np.int64)


def _hash(chars: list[np.ndarray], n: int) -> np.ndarray:
    """The hash of ``grams`` from characters, newest first."""
    h = np.full(n, 7, dtype=np.uint64)
    for x in chars:
        h = _mixed(h, x)
    return h


def _windows(order: int):
    """Of texts (t, n) the n-grams of ``order`` characters with how often they count.

    A task keeps the first ``MEMO`` n-grams it meets and counts them in place; the others are given out piece by piece.
    """
    names = ["s", "w1", "w2", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count = np.zeros(MEMO, np.uint64), np.zeros(MEMO, np.int64)
        first_word, second_word = np.zeros(MEMO, np.int64), np.zeros(MEMO, np.int64)

        def out(w1: np.ndarray, w2: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(w1 >> _BITS), pa.array(w1), pa.array(w2), pa.array(n)], names)

        for b in batches:
            texts, times = b.column(0).to_pylist(), np.asarray(b.column(1).to_pylist(), np.int64)
            for lo, hi in pieces(texts, 400_000):
                c, owner = coded(texts[lo:hi], order)
                at = np.flatnonzero(owner >= 0)
                if not len(at):
                    continue
                key, n = _key(c, order)[at], times[lo:hi][owner[at]]
                slot = (key & np.uint64(MEMO - 1)).astype(np.int64)
                kept = keys[slot] == key
                count += np.bincount(slot[kept], n[kept], MEMO).astype(np.int64)
                new = np.flatnonzero(~kept)
                if not len(new):
                    continue
                _, first, of = np.unique(key[new], return_index=True, return_inverse=True)
                n = np.bincount(of, n[new].astype(np.float64)).astype(np.int64)
                one = new[first]
                w1, w2 = _packed(c, at[one], order)
                # the first of those that want a free place takes it
                free = np.flatnonzero(keys[slot[one]] == 0)
                _, i = np.unique(slot[one][free], return_index=True)
                take = free[i]
                put = slot[one][take]
                keys[put], count[put], first_word[put], second_word[put] = key[one][take], n[take], w1[take], w2[take]
                rest = np.ones(len(one), bool)
                rest[take] = False
                if rest.any():
                    yield out(w1[rest], w2[rest], n[rest])
        held = np.flatnonzero(keys)
        for lo in range(0, len(held), 100_000):
            i = held[lo : lo + 100_000]
            yield out(first_word[i], second_word[i], count[i])

    return run


def corpus_grams(corpus: DataFrame, others: list[str], order: int, own: int, less: DataFrame | None = None) -> DataFrame:
    """The n-grams of all of ``corpus`` (t, n: a text and how often it counts), each once, sorted by their ends in partitions by the last two characters; with grams ``corpus`` already, those of the texts ``less`` are taken off.

    Grams of ``others`` have ``o`` set: they count in the orders below ``own`` only.
    """
    assert 1 < own < order <= 6
    spark = corpus.sparkSession
    if less is None:
        c, owner = coded([t for t in others if t] or [" "], order)
        seen = sorted({(int(a), int(b)) for a, b in zip(*_packed(c, np.flatnonzero(owner >= 0), order), strict=True)})
        other = spark.createDataFrame([(a >> _BITS, a, b, 0, True) for a, b in seen], "s bigint, w1 bigint, w2 bigint, n bigint, o boolean")
        rows = corpus.select("t", "n").mapInArrow(_windows(order), "s bigint, w1 bigint, w2 bigint, n bigint").withColumn("o", F.lit(False)).unionByName(other)
    else:
        gone = less.select("t", "n").mapInArrow(_windows(order), "s bigint, w1 bigint, w2 bigint, n bigint")
        rows = corpus.unionByName(gone.select("s", "w1", "w2", (-F.col("n")).alias("n"), F.lit(False).alias("o")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    once = rows.repartition(parts, "s").groupBy("s", "w1", "w2").agg(F.sum("n").alias("n"), F.bool_or("o").alias("o")).where("n > 0 or o")
    return cut_lineage(once.sortWithinPartitions("w1", "w2"))


def _levels(orders: list[int], own: int, order: int, bits: int):
    """Of sorted n-grams the filled places of the tables of ``orders``: count of the gram, count of its context and continuations of its context.

    A gram of a lower order counts the different longer ones that end in it. Grams of a suffix lie side by
    side, so one reading gives every order; what a batch leaves open goes on in the next one.
    """
    char = np.int64((1 << _BITS) - 1)
    mask = np.uint64((1 << bits) - 1)

    def chars(w1: np.ndarray, w2: np.ndarray) -> list[np.ndarray]:
        return [((w1, w2)[j // 3] >> np.int64(_BITS * (2 - j % 3))) & char for j in range(order)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[bool, list[int]] = {}  # the gram before, among all and among those of the corpus
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> pa.RecordBatch:
            u, i = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(np.bincount(i, np.concatenate([y for _, y in held])))], ["place", "n"])

        for b in batches:
            w1, w2, n, o = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            for whole in (True, False):
                ks = [k for k in orders if (k < own) == whole]
                keep = np.arange(len(w1)) if whole else np.flatnonzero(n > 0)
                if not ks or not len(keep):
                    continue
                cs = chars(w1[keep], w2[keep])
                # from how many characters on a gram differs from the one before: it begins groups of those orders
                new = np.zeros(len(keep), bool)
                begins = [new]
                for j, x in enumerate(cs):
                    diff = np.concatenate([[whole not in last or last[whole][j] != x[0]], x[1:] != x[:-1]])
                    begins.append(begins[-1] | diff)
                last[whole] = [int(x[-1]) for x in cs]
                us = [x.astype(np.uint64) for x in cs]
                for k in ks:
                    at = np.flatnonzero(begins[k])
                    opened = len(at) == 0 or at[0] != 0
                    if opened:
                        at = np.concatenate([[0], at])
                    weights = n[keep] if k == order else begins[k + 1]
                    counts = np.add.reduceat(weights.astype(np.float64), at)
                    gram, context = ((_hash([u[at] for u in us[a:k]], len(at)) & mask).astype(np.int64) for a in (0, 1))
                    fresh = np.ones(len(at))
                    fresh[0] -= opened
                    if k == 1:  # an end may lie in several partitions, so the ends themselves are given
                        held.append((-1 - us[0][at].astype(np.int64), np.ones(len(at))))
                        fresh[:] = 0
                    for kind, (x, w) in enumerate(((gram, counts), (context, counts), (context, fresh))):
                        held.append(((np.int64(k * 3 + kind) << np.int64(bits)) | x, w))
            size += len(w1)
            if size > 100_000 and held:
                yield merged()
                held, size = [], 0
        if held:
            yield merged()

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        place, n = (x.to_numpy(zero_copy_only=False) for x in b.columns)
        yield pa.RecordBatch.from_arrays([pa.array([place.astype(np.int32).tobytes()]), pa.array([n.astype(np.float32).tobytes()])], ["place", "n"])


def tables_of(found: DataFrame, order: int, own: int, bits: int, only: int = 0, times: float = 1.0) -> tuple[list[tuple[Sparse, ...]], float] | None:
    """The tables of orders 1 to ``order`` (of order ``only`` if given, the others empty) from ``corpus_grams``, and the number of characters.

    Counts are divided by ``times``; an n-gram that occurs counts once at least. What is collected is bounded by ``bits``. None if there is no text.
    """
    orders = [only] if only else list(range(1, order + 1))
    n = F.col("n") if times == 1 else F.when(F.col("n") > 0, F.greatest(F.lit(1), F.round(F.col("n") / times))).otherwise(0).cast("bigint").alias("n")
    filled = found.select("w1", "w2", n, "o").mapInArrow(_levels(orders, own, order, bits), "place bigint, n double").groupBy("place").agg(F.sum("n").alias("n")).where("n <> 0")
    parts: list[list[list[Sparse]]] = [[[] for _ in range(3)] for _ in range(order)]
    ends = 0
    for r in filled.mapInArrow(_pack, "place binary, n binary").collect():
        place, n = np.frombuffer(r["place"], np.int32), np.frombuffer(r["n"], np.float32)
        ends += int((place < 0).sum())
        which = place >> bits
        for w in np.unique(which[place >= 0]):
            parts[int(w) // 3 - 1][int(w) % 3].append(((place[which == w] & ((1 << bits) - 1)).astype(np.uint32), n[which == w]))
    tables = [tuple((np.concatenate([np.zeros(0, np.uint32), *(a for a, _ in x)]), np.concatenate([np.zeros(0, np.float32), *(v for _, v in x)])) for x in kinds) for kinds in parts]
    if not len(tables[(only or order) - 1][0][0]):
        return None
    if 1 in orders:
        empty = np.full(1, 7 & ((1 << bits) - 1), np.uint32)
        tables[0] = (*tables[0][:2], (empty, np.full(1, ends, np.float32)))
    # the marks before a text are a character too, and so is what was never seen
    return tables, float(ends + 2)


def corpus_tables(corpus: DataFrame, others: list[str], order: int, own: int, bits: int) -> tuple[list[tuple[Sparse, ...]], float] | None:
    """The tables of orders 1 to ``order`` and the number of characters, as ``KneserNey.fit`` has them, counted in Spark over all of ``corpus`` (t, n: a text and how often it counts).

    The orders below ``own`` are shared with the texts ``others`` of the other classes. The n-grams
    stay distributed; what is collected is bounded by ``bits``. None if there is no text.
    """
    return tables_of(corpus_grams(corpus, others, order, own), order, own, bits)


def corpus_empty(order: int) -> tuple[list[tuple[Sparse, ...]], float]:
    """The tables of a corpus without any text."""
    none = np.zeros(0, np.uint32), np.zeros(0, np.float32)
    return [(none, none, none)] * order, 2.0


class KneserNey:
    """Models of several classes over one hashed space.

    Only the filled places of the tables are held and broadcast; where texts are scored they are laid out so
    that one look gives all classes, and the result of each n-gram is kept for when it comes again.
    """

    def __init__(self, classes: list[str], order: int = 6, own: int = 3, bits: int = 19):
        self.classes, self.order, self.own, self.bits = classes, order, own, bits
        self.mask = np.uint64((1 << bits) - 1)

    def __getstate__(self) -> dict:
        """The filled places, packed: what is broadcast grows with the n-grams seen, not with the space."""
        seen: dict[int, int] = {}
        kept = []
        for by in self.filled.values():
            for ts in by:
                if id(ts) not in seen:
                    seen[id(ts)] = len(kept)
                    kept.append([zlib.compress(a.tobytes() + v.tobytes(), 1) for a, v in ts])
        state = {k: v for k, v in self.__dict__.items() if not k.startswith("_")}
        return state | {"filled": {y: [seen[id(ts)] for ts in by] for y, by in self.filled.items()}, "kept": kept}

    def __setstate__(self, state: dict) -> None:
        kept = []
        for ts in state.pop("kept"):
            raw = [zlib.decompress(x) for x in ts]
            kept.append(tuple((np.frombuffer(x[: len(x) // 2], np.uint32), np.frombuffer(x[len(x) // 2 :], np.float32)) for x in raw))
        self.__dict__ = state | {"filled": {y: [kept[i] for i in by] for y, by in state["filled"].items()}}

    def _dense(self, t: Sparse) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[t[0]] = t[1]
        return out

    @property
    def tables(self) -> dict[str, list[tuple[np.ndarray, ...]]]:
        """Each class's tables of orders 1 to ``order``: counts, counts of the context and its continuations, by place."""
        return {y: [tuple(self._dense(t) for t in ts) for ts in by] for y, by in self.filled.items()}

    def _at(self, h: np.ndarray) -> np.ndarray:
        return (h & self.mask).astype(np.int64)

    def _table(self, grams_: np.ndarray, contexts: np.ndarray, n: np.ndarray) -> tuple[Sparse, ...]:
        out = []
        for places, w in ((grams_, n), (contexts, n), (contexts, np.ones(len(contexts)))):
            u, i = np.unique(self._at(places), return_inverse=True)
            out.append((u.astype(np.uint32), np.bincount(i, w.astype(np.float64)).astype(np.float32)))
        return tuple(out)

    def _tables(self, coded_: list[tuple[np.ndarray, np.ndarray]], first: int, last: int) -> list[tuple[Sparse, ...]]:
        """The tables of orders ``first`` to ``last`` over coded texts; no more than three hashes a character are held at once."""
        c = np.concatenate([x for x, _ in coded_])
        here = np.concatenate([o for _, o in coded_]) >= 0
        out = []
        context, gram = None, np.full(len(c), 7, dtype=np.uint64)
        for k, longer in enumerate(_each_order(c, min(last + 1, self.order)), 1):
            context, gram = gram, longer
            if k > first and k - 1 <= last and k - 1 < self.order:
                # continuation counts of order k - 1: in how many different grams of order k it ends
                _, at = np.unique(gram[here], return_index=True)
                u, i, n = np.unique(context[here][at], return_index=True, return_counts=True)
                out.append(self._table(u, np.concatenate([older[:1], older[:-1]])[here][at][i], n))
            if k == self.order and last == self.order:
                u, i, n = np.unique(gram[here], return_index=True, return_counts=True)
                out.append(self._table(u, np.concatenate([context[:1], context[:-1]])[here][i], n))
            older = context
        return out

    def fit(self, texts: dict[str, Iterable[str]], corpus: DataFrame | None = None, of: str = "") -> KneserNey:
        """From the texts of each class; repeated texts count each. Class ``of`` is counted over ``corpus`` instead, if that holds any text."""
        counted = corpus is not None and corpus_tables(corpus, [t for y in self.classes if y != of for t in texts[y]], self.order, self.own, self.bits)
        if counted:
            return self.take(texts, of, *counted)
        code = {y: coded([t for t in texts[y] if t] or [" "], self.order) for y in self.classes}
        self.types = float(len(np.unique(np.concatenate([np.unique(c) for c, _ in code.values()]))) + 1)
        shared = self._tables(list(code.values()), 1, self.own - 1) if self.own > 1 else []
        self.filled: dict[str, list[tuple[Sparse, ...]]] = {y: shared + self._tables([code[y]], self.own, self.order) for y in self.classes}
        return self

    def take(self, texts: dict[str, Iterable[str]], of: str, tables: list[tuple[Sparse, ...]], types: float) -> KneserNey:
        """From the texts of the classes but ``of``, whose tables, and those of the shared orders, have been counted."""
        shared, whole = tables[: self.own - 1], tables[self.own - 1 :]
        self.types = types
        self.filled = {y: shared + (whole if y == of else self._tables([coded([t for t in texts[y] if t] or [" "], self.order)], self.own, self.order)) for y in self.classes}
        return self

    def with_class(self, of: str, texts: Iterable[str]) -> KneserNey:
        """This model with the counts of class ``of`` from other texts; the shared orders stay."""
        own = self._tables([coded([t for t in texts if t] or [" "], self.order)], self.own, self.order)
        return self.counted(of, self.filled[of][: self.own - 1] + own, self.types)

    def counted(self, of: str, tables: list[tuple[Sparse, ...]], types: float) -> KneserNey:
        """This model with other tables for class ``of`` and the shared orders; the rest is as it was."""
        out = KneserNey(self.classes, self.order, self.own, self.bits)
        out.types = types
        out.filled = {y: tables[: self.own - 1] + (tables if y == of else by)[self.own - 1 :] for y, by in self.filled.items()}
        return out

    def _ready(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each order the places of its grams and what is left of their counts after the discount, and those of its contexts with their divisor and weight of the lower order, less one; the classes side by side.

        Only filled places have a row, and the last row is that of all others, so a worker holds what was seen, not the space.
        """
        if "_laid" not in self.__dict__:
            self._laid = []
            for k in range(1, self.order + 1):
                ys = self.classes if k >= self.own else self.classes[:1]
                grams_ = np.unique(np.concatenate([self.filled[y][k - 1][0][0] for y in ys]))
                contexts = np.unique(np.concatenate([self.filled[y][k - 1][1][0] for y in ys]))
                left, way = np.zeros((len(grams_) + 1, len(ys)), np.float32), np.zeros((len(contexts) + 1, 2 * len(ys)), np.float32)
                for j, y in enumerate(ys):
                    (at, n), (of, tot), (of_typ, typ) = self.filled[y][k - 1]
                    left[np.searchsorted(grams_, at), j] = np.maximum(n - DISCOUNT, 0)
                    i = np.searchsorted(contexts, of)
                    kinds = np.zeros(len(contexts) + 1, np.float32)
                    kinds[np.searchsorted(contexts, of_typ)] = typ
                    way[i, j] = 1 / np.maximum(tot, 1)
                    way[i, len(ys) + j] = DISCOUNT * np.minimum(kinds[i], tot) / np.maximum(tot, 1) - 1
                self._laid.append((grams_, left, contexts, way))
        return self._laid

    def _rows(self, places: np.ndarray, h: np.ndarray, values: np.ndarray) -> np.ndarray:
        at = (h & self.mask).astype(np.uint32)
        if not len(places):
            return values[np.zeros(len(at), np.int64)]
        i = np.minimum(np.searchsorted(places, at), len(places) - 1)
        return values[np.where(places[i] == at, i, len(places))]

    def _logs(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probabilities at some positions, a column a class."""
        here, before = np.full(len(at), 7, np.uint64), np.full(len(at), 7, np.uint64)
        p = np.full((len(at), 1), 1 / (self.types + 1), np.float32)
        for k, (grams_, left, contexts, way) in enumerate(self._ready()):
            x = self._rows(contexts, before, way)
            here = _mixed(here, c[np.maximum(at - k, 0)])
            before = _mixed(before, c[np.maximum(at - k - 1, 0)])
            n = x.shape[1] // 2
            p = np.minimum(self._rows(grams_, here, left) * x[:, :n] + (1 + x[:, n:]) * p, 1)
        return np.log(np.maximum(p, 1e-12))

    def log_probs(self, c: np.ndarray) -> dict[str, np.ndarray]:
        """Per-character log-probability under each class."""
        logs = self._logs(c, np.arange(len(c)))
        return {y: logs[:, j] for j, y in enumerate(self.classes)}

    def gains(self, c: np.ndarray, owner: np.ndarray, drift: float) -> np.ndarray:
        """Per-character log-ratio of each class against the last one, less ``drift``, a row a class; 0 at marks."""
        if "_memo" not in self.__dict__:
            self._memo = np.zeros(MEMO, np.uint64), np.zeros((len(self.classes) - 1, MEMO), np.float32)
        keys, kept = self._memo
        key = _key(c, self.order)
        slot = (key & np.uint64(MEMO - 1)).astype(np.int64)
        out = kept[:, slot]
        missing = np.flatnonzero((keys[slot] != key) & (owner >= 0))
        if len(missing):
            _, first, of = np.unique(key[missing], return_index=True, return_inverse=True)
            at = missing[first]
            logs = self._logs(c, at).T
            new = logs[:-1] - logs[-1:]
            out[:, missing] = new[:, of]
            keys[slot[at]], kept[:, slot[at]] = key[at], new
        out -= np.float32(drift)
        out[:, owner < 0] = 0
        return out

    def joint_ratios(self, c: np.ndarray, ones: list[str], other: str, k: int = 5, a: float = 1.0) -> list[np.ndarray]:
        """Per-position log-ratio of how frequent the k-gram that ends there is in each of some classes against another; 0 where neither has it.

        It doesn't condition on the context, so a text that leaked into the wrong class still shows where it is at home.
        """
        if "_joint" not in self.__dict__:
            self._joint: dict[tuple[str, str, int], np.ndarray] = {}
        for one in ones:
            if (one, other, k) not in self._joint:
                x, y = (self._dense(self.filled[z][k - 1][0]) for z in (one, other))
                rare = a / max(x.sum() + y.sum(), 1)
                r = np.log(x / max(x.sum(), 1) + rare) - np.log(y / max(y.sum(), 1) + rare)
                self._joint[one, other, k] = np.where((x > 0) | (y > 0), r, 0.0).astype(np.float32)
        *_, h = _each_order(c, k)
        at = self._at(h)
        return [self._joint[one, other, k][at] for one in ones]


def spans(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``n`` coded texts the text of each position, marks counting to the one they precede, and where each begins."""
    which = np.maximum.accumulate(owner)
    which[owner < 0] += 1
    which = np.clip(which, 0, max(n - 1, 0))
    return which, np.searchsorted(which, np.arange(n))


def best_windows(gain: np.ndarray, owner: np.ndarray, n: int, spans_: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``n`` texts the stretch with the largest sum of ``gain``: (sum, first position, last position) in the coded array; a sum of 0 where no position gains.

    A best stretch begins and ends at positions that gain, so only those are looked at.
    """
    which, starts = spans_ or spans(owner, n)
    best, first, last = np.zeros(n), starts.copy(), starts.copy()
    at = np.flatnonzero((gain > 0) & (owner >= 0))
    if not len(at):
        return best, first, last
    s = np.cumsum(np.where(owner >= 0, gain, 0), dtype=np.float64)
    whose, end = which[at], s[at]
    # a text's own running minimum: each text is set so far below the one before that no older minimum reaches into it
    shift = whose * 1e6
    prev = end - gain[at] - shift
    low = np.minimum.accumulate(prev)
    gainful = end - shift - low
    begins = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
    top = np.maximum.reduceat(gainful, begins)
    owners = whose[begins]
    best[owners] = top
    hits = np.flatnonzero(gainful == np.repeat(top, np.diff(np.append(begins, len(at)))))
    _, i = np.unique(whose[hits], return_index=True)
    hit = hits[i]
    # the window begins at the last position whose sum before it was lowest
    low_at = np.maximum.accumulate(np.where(prev <= low + 1e-9, np.arange(len(at)), 0))
    first[owners], last[owners] = at[low_at[hit]], at[hit]
    return best, first, last
