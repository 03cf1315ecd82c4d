"""Abusive, hateful and sexual language: class-conditional Kneser-Ney models over disguised spelling.

A document is cut into segments (lines and sentences); each segment is folded to plain spelling
(compatibility forms, look-alike letters, marks, invisible characters, digits for letters, stretched
and spaced-out words) and read by two models, one of toxic and one of ordinary language. The stretch
with the largest sum of log-likelihood ratios, each character less a drift, tells where in a segment
such language stands; what decides is the ratio normalised by length, over that stretch and as much
around it as makes ``LEAST`` characters, so a misspelt word doesn't count. The score of a document is
that of its surest segment.

The models are fitted on the reviewed documents (``max_reviewed`` of them, chosen by hash), on a few
common expressions, and, for ordinary language, on the wordings that recur over all documents. A review
tells of a document only whether there is such language in it, and reviewers err. So wordings that stand
in documents passed by reviewers too, beyond what errors explain, are not toxic, and the toxic segments
of a flagged document are chosen in rounds by models that were fitted without the documents of its fold.

Null, empty and blank texts score 0. Repeated rows score each. Without reviews only the common
expressions stand for the toxic class.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattlake.llm.lm import KneserNey, best_windows, coded, pieces, spans
from wattlake.session import spread

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһкмтвнԛԝАЕОРСУХІЈЅКМТВНαορυνικτεΑΟΡΤΕΙΚΝΜΗΒΧΥΖı", "aeopcyxijsdhkmtbhqwaeopcyxijskmtbhaopuvikteaoptieknmhbxyzi".ljust(58)[:58])
# Digits and signs written for letters inside words.
LEET = str.maketrans("013457@$!|", "oieastasil")
# Common expressions that stand for the class whatever was reviewed.
EXPRESSIONS = tuple(
    """you are an idiot|you moron|you stupid bitch|you bastard|you piece of shit|you asshole|you loser|you scumbag|what an idiot|are you stupid|shut up|shut your mouth|go to hell|burn in hell|rot in hell|drop dead
kill yourself|i will kill you|i will hurt you|i hope you die|i know where you live|nobody likes you|fuck you|fuck off|screw you|you make me sick|you are disgusting|you are worthless
immigrants are vermin|foreigners are animals|they are subhuman|send them back|they should all be shot|gay people are sick|women are stupid|i hate those people|go back to where you came from
send me nudes|send nudes|show me your tits|i want you naked|i want to fuck you|take off your clothes|suck my cock|my dick is hard|nice ass|live sex cams|hot singles|escort girls|porn
espèce d'idiot|ta gueule|va te faire foutre|sale connard|hijo de puta|vete al infierno|eres un idiota|puta madre|du arschloch|halt die fresse|fahr zur hölle|verdammter idiot|你这个白痴|去死|滚开""".replace("\n", "|").split("|")
)

_ZERO = re.compile("[​-‏⁠-⁤﻿­͏᠎️]")
_HEAD = re.compile(r"^\s*(?:\[\d\d?:\d\d\]\s*[\w ]{1,20}:|\d+(?:\.\d+)*\s{2,}|[-*•]\s+)\s*")
_CUT = re.compile(r"(?<=[.!?。！？;])[\"'”’)]*\s+|\n+|[\U0001F000-\U0001FAFF☀-➿]+")
_SPACED = re.compile(r"(?<![^\W\d_])(?:[^\W\d_][ .\-_*]){2,}[^\W\d_](?![^\W_])")
_STRETCH = re.compile(r"(.)\1{2,}")
_SPLIT = re.compile(r"(?<=[a-z])[-.'’*_·](?=[a-z])")
_WORD = re.compile(r"[^\s\-/]+")
_LONE = re.compile(r"[^\W\d_][ .\-_*][^\W\d_][ .\-_*]")
_SIGN = re.compile(r"[\d@$!|]")
_NUMBER = re.compile(r"\d[\d.,]*")


def _word(m: re.Match) -> str:
    w = m[0]
    letters = sum(ch.isalpha() for ch in w)
    if letters >= 2 and letters * 2 > sum(ch.isalnum() or ch in "@$!|" for ch in w.rstrip("!?.,;:")):
        end = w.rstrip("!?.,;:|")
        return end.translate(LEET) + w[len(end) :]
    return w


def fold(text: str) -> str:
    """A segment in plain spelling and lower case."""
    t = text
    if not t.isascii():
        t = unicodedata.normalize("NFKC", _ZERO.sub("", t))
        t = unicodedata.normalize("NFKD", t.translate(LOOKALIKES))
        t = "".join(ch for ch in t if not unicodedata.combining(ch))
    t = t.lower()
    if _LONE.search(t):
        t = _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m[0]), t)
    if _SIGN.search(t):
        t = _NUMBER.sub("0", _WORD.sub(_word, t))
    t = _SPLIT.sub("", t)
    t = _STRETCH.sub(r"\1", t)
    return " ".join(t.split())


def segments(text: str | None) -> list[str]:
    """The lines and sentences of a text, folded, without what stands before a spoken or numbered line."""
    if not text:
        return []
    out = []
    for line in text.split("\n"):
        for s in _CUT.split(_HEAD.sub("", line)):
            f = fold(s) if s else ""
            if len(f) > 2:
                out.append(f"{f} ")
    return out


DRIFT = 0.25
#: Characters over which the ratio is normalised at least, if the segment has as many.
LEAST = 24
#: Summed ratio of a stretch, and ratio normalised by length, from which a segment makes a document a case.
THRESHOLD, RATE = 15.0, 0.6
#: What a doubling of the odds is worth in both.
SCALE, RATE_SCALE = 4.0, 0.1
FOLDS = 4


def ratios(model: KneserNey, texts: list[str], drift: float = DRIFT) -> tuple[np.ndarray, np.ndarray]:
    """For each folded text the largest windowed log-likelihood ratio, and the ratio normalised by length around that window."""
    if not texts:
        return np.zeros(0), np.zeros(0)
    out = []
    for lo, hi in pieces(texts):
        c, owner = coded(texts[lo:hi], model.order)
        g, parts = model.gains(c, owner, drift)[0], spans(owner, hi - lo)
        best, frm, at = best_windows(g, owner, hi - lo, parts)
        size = np.array([len(x) for x in texts[lo:hi]])
        first = parts[1] + model.order
        wide = np.minimum(np.maximum(at - frm + 1, LEAST), size)
        begin = np.clip(frm - (wide - (at - frm + 1)) // 2, first, first + size - wide)
        total = np.concatenate([[0.0], np.cumsum(np.where(owner >= 0, g + drift, 0), dtype=np.float64)])
        out.append((best, np.where(best > 0, (total[begin + wide] - total[begin]) / np.maximum(wide, 1), 0.0)))
    return tuple(np.concatenate([x[i] for x in out]) for i in range(2))


def sureness(ratio: np.ndarray, by_length: np.ndarray) -> np.ndarray:
    """The log-odds of a segment: what the weaker of its two ratios says; 0 where both just reach their bounds."""
    return np.minimum((ratio - THRESHOLD) / SCALE, (by_length - RATE) / RATE_SCALE)


def fit(reviewed: list[tuple[str | None, bool]], recurrent: list[str] = (), rounds: int = 4, least: float = 6.0, max_plain: int = 25_000, order: int = 6, own: int = 3, bits: int = 20, errs: int = 4) -> KneserNey:
    """The two models, from (text, flagged) of reviewed documents and from wordings that recur over the whole corpus.

    A wording may be toxic if at most one in ``errs`` + 1 of the reviewed documents that hold it were passed; at
    first all such count, then those that models without their own fold find so. Recurring wordings are ordinary
    unless the reviews speak against it in that way. Of the ordinary segments ``max_plain`` are used, chosen by hash.
    """
    fixed = [f"{fold(e)} " for e in EXPRESSIONS] * 2
    docs = [(list(dict.fromkeys(segments(t))), bool(y)) for t, y in reviewed]
    held: dict[str, list[int]] = {}
    for s, y in docs:
        for x in s:
            held.setdefault(x, [0, 0])[y] += 1
    bad = lambda x: x in held and held[x][1] > 0 and errs * held[x][0] <= held[x][1]
    common = dict.fromkeys(x for r in recurrent for x in segments(r))
    free = sorted({x for x, (n, y) in held.items() if n and n >= y}, key=lambda x: zlib.crc32(x.encode()))[:max_plain]
    ordinary = sorted(x for x in common if not bad(x))
    known = set(ordinary)
    flagged = [(i % FOLDS, [x for x in s if bad(x) and x not in known]) for i, (s, y) in enumerate(docs) if y]
    toxic = [s for _, s in flagged]
    plain = free + ordinary
    model = KneserNey(["toxic", "plain"], order, own, bits).fit({"toxic": fixed + [x for t in toxic for x in t], "plain": plain})
    for _ in range(rounds):
        chosen: list[list[str]] = [[]] * len(flagged)
        for k in range(FOLDS):
            apart = model.with_class("toxic", fixed + [x for (f, _), t in zip(flagged, toxic, strict=True) if f != k for x in t])
            mine = [i for i, (f, _) in enumerate(flagged) if f == k]
            r = ratios(apart, [x for i in mine for x in flagged[i][1]])[0]
            at = 0
            for i in mine:
                s = flagged[i][1]
                v, at = r[at : at + len(s)], at + len(s)
                chosen[i] = [x for x, w in zip(s, v, strict=True) if w >= max(least, 0.3 * v.max())]
        toxic = chosen
        taken = {x for t in toxic for x in t}
        rest = dict.fromkeys(x for _, s in flagged for x in s if x not in taken)
        few = [x for x, v in zip(free, ratios(model, free)[0], strict=True) if v < 4 * least]
        low = [x for x, v in zip(rest, ratios(model, list(rest))[0], strict=True) if v < least]
        model = KneserNey(["toxic", "plain"], order, own, bits).fit({"toxic": fixed + [x for t in toxic for x in t], "plain": few + ordinary * 2 + low})
    return model


def recurring(docs: DataFrame, id_: str, text: str, share: float = 1 / 1000, least: int = 3) -> DataFrame:
    """(segment): wordings, numbers aside, that stand in at least ``share`` of all documents and in ``least`` of them.

    Counted over all documents by hash. There can be no more of them than a document has segments on
    average, divided by ``share``, whatever the number of documents; so the result may be collected.
    """
    cut = F.split(F.regexp_replace(F.lower(F.col(text)), r"(?<=[.!?。！？;])[\"'”’)]*\s+", "\n"), "\n")
    plain = F.transform(cut, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"^\s*(\[\d\d?:\d\d\]\s*[\w ]{1,20}:|\d+(\.\d+)*\s{2,}|[-*•]\s+)\s*", ""), r"\d[\d.,]*", "0")))
    own = F.array_distinct(F.filter(plain, lambda x: F.length(x).between(3, 2000)))
    rows = docs.where(F.col(text).isNotNull()).select(F.explode(own).alias("segment")).withColumn("h", F.xxhash64("segment"))
    n = docs.where(F.col(text).isNotNull()).count()
    often = rows.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= max(least, n * share)).select("h")
    return rows.join(F.broadcast(often), "h").groupBy("h").agg(F.min("segment").alias("segment")).select("segment")


def train(docs: DataFrame, id_: str, text: str, reviews: DataFrame, flagged: str = "flagged", max_reviewed: int = 8_000) -> KneserNey:
    """Fit on the reviewed documents, at most ``max_reviewed`` of them, and on the recurring wordings of all documents. Documents on which reviewers are even are left out."""
    votes = reviews.where(F.col(flagged).isNotNull()).groupBy(id_).agg(F.avg(F.col(flagged).cast("double")).alias("v")).where("v <> 0.5")
    some = votes.orderBy(F.xxhash64(id_)).limit(max_reviewed)
    rows = docs.select(id_, text).join(some, id_).where(F.col(text).isNotNull()).select(id_, text, "v").toPandas().sort_values(id_)
    common = sorted(r[0] for r in recurring(docs, id_, text).toLocalIterator())
    return fit([(t, v > 0.5) for t, v in zip(rows[text], rows["v"], strict=True)], common)


def score(docs: DataFrame, id_: str, text: str, model: KneserNey, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, score, ratio, by_length, flagged) for each document, the ratios those of its surest segment."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    d = spread(docs.select(id_, *keep, F.col(text).cast("string").alias("__text")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            n = b.num_rows
            worst, even, odds = np.zeros(n), np.zeros(n), np.full(n, -np.inf)
            seen: dict[str, int] = {}
            part: list[str] = []
            of: list[int] = []
            at: list[int] = []
            size = 0

            def flush() -> None:
                r, q = ratios(m, part)
                z = sureness(r, q)
                doc, seg = np.array(of), np.array(at)
                by = np.lexsort((z[seg], doc))
                last = np.flatnonzero(np.append(doc[by][1:] != doc[by][:-1], True))
                i, j = doc[by][last], seg[by][last]
                better = z[j] > odds[i]
                i, j = i[better], j[better]
                worst[i], even[i], odds[i] = r[j], q[j], z[j]

            for lo in range(0, n, 256):
                for i, t in enumerate(b.column(b.num_columns - 1).slice(lo, 256).to_pylist(), lo):
                    for x in segments(t):
                        if x not in seen:
                            seen[x] = len(part)
                            part.append(x)
                            size += len(x)
                        of.append(i)
                        at.append(seen[x])
                        if size > 200_000:
                            flush()
                            seen.clear(), part.clear(), of.clear(), at.clear()
                            size = 0
            if part:
                flush()
            p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            p[worst <= 0] = 0
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(p), pa.array(worst), pa.array(even), pa.array((odds >= 0) & (worst > 0))], [*b.schema.names[:-1], "score", "ratio", "by_length", "flagged"]
            )

    return d.mapInArrow(run, f"{schema}, score double, ratio double, by_length double, flagged boolean")
