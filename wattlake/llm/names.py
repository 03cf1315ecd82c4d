"""Variant spellings of organisation names.

A name is read into tokens; a token is a word of the trade (by itself, by its abbreviation, by the
initials of a phrase, or by a small edit) or part of the proper name, in whatever order they stand.
Legal forms, states, departments and articles say nothing. Names in brackets and behind "doing
business as" are further names of the same organisation.

Proper names within a small edit distance are found by a symmetric-delete index: every proper name is
filed under each string that deleting up to two letters gives, and names that share a file entry are
compared. Proper names of several tokens are filed so token by token too, and looked up by their
rarest token; the tokens of both are aligned by optimal assignment, each within its own edits or an
initial for the token, in whatever order. The kind of organisation must be the same where both name
one, and a spelling joins the proper name that more spellings share. A name without a kind joins the
organisation of its place only if there is but one, and a bare acronym the one organisation that has it.

Nulls, blanks and names that stand for no organisation (none, various, unknown) have no pair.
Counts are of distinct names, so repeated rows change nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wattlake.functions.text import norm
from wattlake.session import cut_lineage, spread

# Kinds of utility organisations.
KINDS = """public utility district|gas company|water power|electric cooperative|light department|power light|municipal utility|clean energy authority|rural electric association|energy services|electric company|power company|public power district
utility commission|utility board|irrigation district|electric membership corporation|water district|energy cooperative|light water|electric department""".replace("\n", "|").split("|")
# Common abbreviations of the words of the trade.
SHORT = dict(
    x.split("=")
    for x in """elec=electric|el=electric|coop=cooperative|cooperatives=cooperative|co=company|comp=company|cmpny=company|dept=department|dep=department|muni=municipal|mun=municipal|munic=municipal|utils=utility|util=utility|utilities=utility|utilites=utility
pwr=power|pow=power|lt=light|lighting=light|lgt=light|auth=authority|assoc=association|assn=association|asso=association|svcs=services|svc=services|serv=services|service=services|dist=district|pub=public|wtr=water|enrgy=energy|cln=clean
rur=rural|corp=corporation|inc=incorporated|ltd=limited|bd=board|comm=commission""".replace("\n", "|").split("|")
)
# Words that say nothing of which organisation is meant.
EMPTY = frozenset("the of and for a an company natural incorporated corporation limited llc ltd inc corp lp pc rebate rebates team office customer programs program customers efficiency desk".split())
NO_ONE = frozenset("n/a na none null unknown various multiple other others providers several all utilities utility company companies any not applicable tbd local your statewide nationwide varies".split())
_BRACKET = re.compile(r"\(([^()]*)\)?")
_ALSO = re.compile(r"\s*,?\s+(?:d\s*/\s*b\s*/\s*a|d\.b\.a\.|dba|doing business as|also known as|a/k/a|aka|formerly|trading as|t/a)\s+", re.I)
_BRAND = re.compile(r"^(.*?),?\s+an?\s+(?:brand|division|unit|subsidiary|program|affiliate|service)\s+of\s+(.*)$", re.I)
_OFFICE = re.compile(r"\s*(?:-|/|,|\()?\s*\b(?:rebates?|energy efficiency|customer|efficiency)\s+(?:dept|department|team|office|desk|programs?|services?|center)\b\.?\)?\s*$|\s*\(?\brebates\b\)?\s*$")

WORDS = frozenset(w for k in KINDS for w in k.split())


@cache
def _initials() -> dict[str, tuple[str, ...]]:
    """Initials of the kinds, such as pud and pandl."""
    out: dict[str, tuple[str, ...]] = {}
    for k in KINDS:
        w = tuple(k.split())
        for s in ("".join(x[0] for x in w), "and".join(x[0] for x in w)):
            if len(s) > 1:
                out.setdefault(s, w)
    return out | {"ce": ("clean", "energy")}


def edit_distance(a: str, b: str, most: int = 2) -> int:
    """Insertions, deletions, replacements and swaps of neighbours; ``most`` + 1 if there are more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


@cache
def trade_word(t: str) -> tuple[str, ...]:
    """The words of the trade that a token stands for, or nothing."""
    if t in WORDS or t in EMPTY:
        return (t,)
    if t in SHORT:
        return (SHORT[t],)
    if t in _initials():
        return _initials()[t]
    if len(t) >= 4:
        near = sorted((edit_distance(t, w, 1 if len(w) < 8 else 2), w) for w in (*WORDS, *SHORT.values(), "natural", "incorporated", "corporation", "lighting") if len(w) >= 5 and w[0] == t[0] or len(w) >= 7)
        if near and near[0][0] <= (1 if len(near[0][1]) < 8 else 2):
            return (SHORT.get(near[0][1], near[0][1]),)
    return ()


def _plain(name: str) -> str:
    t = unicodedata.normalize("NFKD", name.lower())
    t = "".join(c for c in t if not unicodedata.combining(c))
    t = re.sub(r"(?<=[a-z])[01345](?=[a-z]|\b)|(?<![a-z0-9])[01345](?=[a-z])", lambda m: "olieas"["013450".index(m[0])] if m[0] != "5" else "s", t)
    t = re.sub(r"(?<=[a-z])['’`](?=[a-z])", "", t)
    t = re.sub(r"(?<=[a-z])-(?=[a-z])", "", t)
    t = re.sub(r"\b([a-z])\s*[&+]\s*([a-z])\b", r"\1and\2", t)
    t = re.sub(r"\b((?:[a-z]\.){2,})", lambda m: m[1].replace(".", ""), t)
    return t.replace("&", " and ").replace("+", " and ")


def proper_tokens(text: str) -> list[str]:
    """The tokens of the proper name in one name, in order."""
    return [t for t in re.findall(r"[a-z0-9]+", text) if not trade_word(t) and t not in NO_ONE]


def read_tokens(text: str) -> tuple[str, tuple[str, ...]]:
    """(proper name, kind) of one name: the letters of its own tokens in order, and its words of the trade in order of the alphabet."""
    proper, kind = [], set()
    for t in re.findall(r"[a-z0-9]+", text):
        w = trade_word(t)
        if w:
            kind.update(w)
        elif t not in NO_ONE:
            proper.append(t)
    return "".join(proper), tuple(sorted(kind - EMPTY))


def read_name(name: str) -> tuple[str, tuple[str, ...], str]:
    """(proper name, kind, proper name of its other name) of a normalised name."""
    return read_whole(name)[:3]


def _acronyms(text: str) -> set[str]:
    """The initials of a full name, with and without those of its small words."""
    w = re.findall(r"[a-z]+", text)
    big = [x for x in w if x not in ("and", "of", "the", "for")]
    return {"".join(x[0] for x in v) for v in (w, [x for x in w if x != "the"], [x for x in w if x not in ("of", "the", "for")], big)}


def read_whole(name: str) -> tuple[str, tuple[str, ...], str, list[str], list[str]]:
    """What ``read_name`` gives, the tokens of the proper name and the acronyms that stand for the name."""
    t = _OFFICE.sub("", _plain(name))
    parts = _ALSO.split(t, maxsplit=1)
    other = ""
    if m := _BRAND.match(t):
        other, t = m[1], m[2]
    elif len(parts) == 2:
        t, other = parts
    inside = [x.strip() for x in _BRACKET.findall(t)]
    outside = _OFFICE.sub("", _BRACKET.sub(" ", t))
    full = [x for x in inside if len(x.split()) > 1 and read_tokens(x)[0]]
    if full:
        t, other = full[0], other or outside
    else:
        t = outside
    proper, kind = read_tokens(t)
    alias, alias_kind = read_tokens(other)
    own, short = proper_tokens(t), _acronyms(t) if kind else set()
    if other and len(alias) <= 6 and proper.startswith(alias[:1]) and not alias_kind:
        short.add(alias)  # initials of the full name
        alias = ""
    if not proper and alias:
        proper, kind, alias, own = alias, kind or alias_kind, "", proper_tokens(other)
    return proper, kind, "" if alias == proper else alias, own, sorted(x for x in short if 3 <= len(x) <= 6 and proper.startswith(x[:1]))


def deletions(s: str, most: int = 2) -> set[str]:
    """Every string left when up to ``most`` letters are taken out; only one from short strings."""
    n = most if len(s) >= 8 else 1
    out = {s}
    for k in range(1, min(n, max(0, len(s) - 2)) + 1):
        out |= {"".join(c for i, c in enumerate(s) if i not in cut) for cut in combinations(range(len(s)), k)}
    return out


def distinct_names(parts: list[DataFrame]) -> DataFrame:
    """(name) of all values of single-column tables, normalised, each once."""
    out = parts[0].toDF("raw")
    for p in parts[1:]:
        out = out.unionByName(p.toDF("raw"))
    return out.where("raw is not null").distinct().select(norm("raw").alias("name")).where("name <> ''").distinct()


def read_names(names: DataFrame) -> DataFrame:
    """(name, proper, kind, other, tokens, short) of names that stand for an organisation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            r = [read_whole(x) for x in pdf["name"]]
            yield pd.DataFrame({"name": pdf["name"], "proper": [x[0] for x in r], "kind": [" ".join(x[1]) for x in r], "other": [x[2] for x in r], "tokens": [" ".join(x[3]) for x in r], "short": [x[4] for x in r]})

    read = spread(names).mapInPandas(run, "name string, proper string, kind string, other string, tokens string, short array<string>")
    # a name of two letters is one if it has a kind beside it
    nobody = F.col("proper").isin(*[x.replace("/", "") for x in sorted(NO_ONE)])
    return read.where((F.length("proper") > 2) | ((F.length("proper") == 2) & (F.col("kind") != "") & ~nobody))


def _token_cost(a: str, b: str) -> int | None:
    """Edits between two tokens, 1 for an initial and its token; None if they don't stand for the same word."""
    if a == b:
        return 0
    n = min(len(a), len(b))
    if n == 1:
        return 1 if a[0] == b[0] and max(len(a), len(b)) > 3 else None
    if n < 4:
        return None
    most = 2 if n >= 8 else 1
    d = edit_distance(a, b, most)
    return d if d <= most else None


def align(a: list[str], b: list[str]) -> int | None:
    """The least sum of edits over all assignments of the tokens of ``a`` to those of ``b``; None if there is none, or only initials meet."""
    if len(a) != len(b):
        return None
    best: dict[int, int] = {0: 0}  # by the set of tokens of b that are taken
    for x in a:
        costs = [(j, c) for j, y in enumerate(b) if (c := _token_cost(x, y)) is not None]
        now: dict[int, int] = {}
        for taken, sum_ in best.items():
            for j, c in costs:
                if not taken >> j & 1:
                    now[taken | 1 << j] = min(now.get(taken | 1 << j, 1 << 30), sum_ + c)
        best = now
    full = best.get((1 << len(b)) - 1)
    return full if full is not None and any(len(x) > 1 and len(y) > 1 and _token_cost(x, y) is not None for x in a for y in b) else None


def aligned(propers: DataFrame) -> DataFrame:
    """(a, b, distance) of proper names of several tokens (proper, tokens) whose tokens can be assigned to each other, both ways.

    As every token must find its own, a name is looked up by its rarest one of more than one letter
    only, so a word that very many names share (north, upper) makes no candidates by itself.
    """

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(t, d) for t in pdf["token"] for d in deletions(t)], columns=["token", "entry"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            d = [align(x.split(" "), y.split(" ")) for x, y in zip(pdf["tokens_a"], pdf["tokens_b"], strict=True)]
            yield pd.DataFrame([(a, b, c) for a, b, c in zip(pdf["a"], pdf["b"], d, strict=True) if c is not None], columns=["a", "b", "distance"])

    p = propers.select("proper", "tokens").where("tokens like '% %'").distinct().withColumn("m", F.size(F.split("tokens", " ")))
    held = cut_lineage(p.select("proper", "tokens", "m", F.explode(F.array_distinct(F.split("tokens", " "))).alias("token")).where("length(token) > 1"))
    number = held.groupBy("token").agg(F.count("*").alias("n"))
    e = number.select("token").mapInPandas(index, "token string, entry string").select("token", F.xxhash64("entry").alias("e"))
    rarest = held.join(number, "token").groupBy("proper", "tokens", "m").agg(F.min(F.struct("n", "token")).getField("token").alias("token"))
    x = rarest.join(e, "token").select(F.col("proper").alias("a"), F.col("tokens").alias("tokens_a"), "m", "e")
    # an initial may stand for the rarest token of the other name
    first = rarest.select(F.col("proper").alias("a"), F.col("tokens").alias("tokens_a"), "m", F.xxhash64(F.lit("initial"), F.substring("token", 1, 1)).alias("e"))
    y = held.join(e, "token").select(F.col("proper").alias("b"), F.col("tokens").alias("tokens_b"), "m", "e")
    lone = p.select(F.col("proper").alias("b"), F.col("tokens").alias("tokens_b"), "m", F.explode(F.array_distinct(F.split("tokens", " "))).alias("t")).where("length(t) = 1").select("b", "tokens_b", "m", F.xxhash64(F.lit("initial"), "t").alias("e"))
    c = x.unionByName(first).join(y.unionByName(lone).hint("merge"), ["e", "m"]).where("a <> b").select("a", "b", "tokens_a", "tokens_b").distinct()
    got = c.mapInPandas(compare, "a string, b string, distance int")
    return got.unionByName(got.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance")).groupBy("a", "b").agg(F.min("distance").alias("distance"))


def similar(propers: DataFrame) -> DataFrame:
    """(a, b, distance) of proper names within a small edit distance, both ways, by the symmetric-delete index.

    Entries that very many names share would be short strings only, as two letters at most are taken out.
    """

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, d) for p in pdf["proper"] for d in deletions(p)]
            yield pd.DataFrame(rows, columns=["proper", "entry"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            d = [edit_distance(a, b) for a, b in zip(pdf["a"], pdf["b"], strict=True)]
            out = pdf.assign(distance=d)
            short = out[["a", "b"]].map(len).min(axis=1)
            yield out[out["distance"] <= (short >= 8).map({True: 2, False: 1})]

    e = propers.select("proper").distinct().mapInPandas(index, "proper string, entry string").select("proper", F.xxhash64("entry").alias("e"))
    # the index is larger than what it is made from, so the planner's guess of its size must not make it a broadcast
    pairs = e.alias("x").join(e.alias("y").hint("merge"), F.expr("x.e = y.e and x.proper <> y.proper")).select(F.col("x.proper").alias("a"), F.col("y.proper").alias("b")).distinct()
    return pairs.mapInPandas(compare, "a string, b string, distance int")


def organisations(names: DataFrame) -> DataFrame:
    """(name, proper, kind) where the last two are those of the organisation that the name means."""
    r = cut_lineage(read_names(names))
    nodes = r.groupBy("proper", "kind").agg(F.count("*").alias("n"))
    whole = nodes.groupBy("proper").agg(F.sum("n").alias("all"))
    nodes = cut_lineage(nodes.join(whole, "proper").withColumn("n", F.when(F.col("kind").isin("", "energy"), F.col("all")).otherwise(F.col("n"))))
    near = similar(nodes).unionByName(aligned(r)).groupBy("a", "b").agg(F.min("distance").alias("distance"))
    # a spelling joins the neighbour that more spellings share; kinds must agree where both are given
    a, b = nodes.toDF("a", "kind_a", "n_a", "all_a"), nodes.toDF("b", "kind_b", "n_b", "all_b")
    free_a, free_b = (F.col(c).isin("", "energy") for c in ("kind_a", "kind_b"))
    same = F.col("kind_a") == F.col("kind_b")
    rank = F.struct(same | free_a, -F.col("distance"), F.col("all_b"), F.col("b"))
    more = (F.col("all_b") > F.col("all_a")) | ((F.col("all_b") == F.col("all_a")) & (F.col("b") < F.col("a")))
    # two proper names that are both well attested are two organisations, however close
    typo = (F.col("n_a") <= 2) | (F.col("n_b") >= 4 * F.col("n_a")) | (F.col("distance") == 0)  # the same tokens in another order
    step = near.join(a, "a").join(b, "b").where((same | free_a | free_b) & more & typo).groupBy("a", "kind_a").agg(F.max_by("b", rank).alias("to"))
    step = cut_lineage(step.toDF("proper", "kind", "to"))
    moved = True
    while moved:  # follow each spelling to the end of its chain, by doubling; a chain has no circle, as each hop leads to a name that more spellings share
        hop = step.toDF("to", "kind", "to2")
        far = cut_lineage(step.join(hop, ["to", "kind"], "left").select("proper", "kind", F.coalesce("to2", "to").alias("to"), F.col("to2").isNotNull().alias("moved")))
        moved = not far.where("moved").isEmpty()
        step = far.drop("moved")
    r = cut_lineage(r.join(step, ["proper", "kind"], "left").withColumn("proper", F.coalesce("to", "proper")).drop("to"))

    kinds = r.where("kind not in ('', 'energy')").groupBy("proper", "kind").agg(F.count("*").alias("n"))
    one = kinds.groupBy("proper").agg(F.count("*").alias("kinds"), F.max_by("kind", "n").alias("its_kind")).where("kinds = 1").select("proper", "its_kind")
    # other names: what they stand for, if that is one organisation and no place of its own
    called = r.where("other <> '' and kind <> ''").select(F.col("other").alias("proper"), F.col("proper").alias("of"), F.col("kind").alias("of_kind")).distinct()
    called = called.join(kinds.select("proper").distinct(), "proper", "left_anti").groupBy("proper").agg(F.count("*").alias("orgs"), F.max(F.struct("of", "of_kind")).alias("o")).where("orgs = 1").select("proper", "o.*")
    typos = similar(called.select("proper").unionByName(r.where("kind in ('', 'energy')").select("proper")))
    loose = typos.join(called.withColumnRenamed("proper", "b"), "b").groupBy(F.col("a").alias("proper")).agg(F.min_by(F.struct("of", "of_kind"), "distance").alias("near"))
    # acronyms: of one organisation only, and no proper name of one
    short = r.where("kind <> ''").select(F.explode("short").alias("acronym"), F.col("proper").alias("of"), F.col("kind").alias("of_kind")).distinct()
    short = short.groupBy("acronym").agg(F.count("*").alias("orgs"), F.max(F.struct("of", "of_kind")).alias("long")).where("orgs = 1")
    short = short.join(kinds.select(F.col("proper").alias("acronym")).distinct(), "acronym", "left_anti").select(F.col("acronym").alias("proper"), "long")
    r = r.join(called, "proper", "left").join(loose, "proper", "left").join(one, "proper", "left").join(short, "proper", "left")
    free = F.col("kind").isin("", "energy")
    return r.select(
        "name",
        F.when(free, F.coalesce("of", F.when(F.col("its_kind").isNull(), F.coalesce("near.of", "long.of")), "proper")).otherwise(F.col("proper")).alias("proper"),
        F.when(free, F.coalesce("of_kind", "its_kind", "near.of_kind", "long.of_kind", F.lit(""))).otherwise(F.col("kind")).alias("kind"),
    )


def pairs(orgs: DataFrame) -> DataFrame:
    """(name_a, name_b) of names of one organisation, name_a < name_b."""
    x = orgs.select("proper", "kind", "name")
    y = x.withColumnRenamed("name", "name_b")
    return x.withColumnRenamed("name", "name_a").join(y, ["proper", "kind"]).where("name_a < name_b").select("name_a", "name_b")
