"""Matching records of two sources without a key, by collective graph linkage.

Every record has partial, noisy attributes: its organisation, the product its name is
about, the customer group, words of a brand, a place in the name, the state, dates and the rate. Records
that share all of them are one node with a count, so copies make no edges of their own. Edges are drawn between
nodes of the two sources that share a block of rare attributes; an edge weighs the sum of the rarity
(inverse frequency) of what it shares, less that of what contradicts. Meta-blocking prunes: of the edges of a node only those of at
least ``keep`` of its best weight stay. The weights are then refined by the neighbours: records of
one source with the same name, organisation and group support each other's edges, until no weight
moves by more than ``eps`` (or ``rounds`` are over); last, each record takes its best edge.

The product is told by a naive Bayes model over word parts, fitted on a bounded sample of the rows
that name their product themselves; the vocabulary of names (words many organisations use) is counted
over all rows. Stated groups, brands, places and products must agree; how a rebate is paid may not.

Nulls: a record without an organisation or name has no match. Repeated rows are matched each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlake.functions.text import norm
from wattlake.llm.names import edit_distance, similar
from wattlake.session import cut_lineage, let_go

# Words for how a program pays, words that join, and words for groups of customers.
PAYMENT = frozenset("rebate rebates incentive incentives discount discounts loan loans bill credit credits instant offer offers savings program programs".split())
JOINING = frozenset("for of the and a an to in on with".split())
GROUPS = (
    (r"\bsmall[ -]?biz\b|\bsmall business(?:es)?\b|\bsmb\b", "small business"),
    (r"\blow[ -]?income\b|\bincome[ -]qualified\b", "low-income"),
    (r"\bmulti-?family\b|\bapartments?\b", "multifamily"),
    (r"\bagricultural\b|\bagriculture\b|\bag\b|\bfarms?\b", "agricultural"),
    (r"\bresidential\b|\bres\b\.?|\bhome\b|\bhomes\b|\bhousehold\b", "residential"),
    (r"\bcommercial\b|\bcomm'l\b|\bcomml\b|\bbusiness\b", "commercial"),
)
# Abbreviations of the states.
STATES = frozenset("al ak az ar ca co ct dc de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy".split())
# Names of the states and their abbreviations.
STATE_NAMES = dict(
    x.split("=")
    for x in """alabama=AL|alaska=AK|arizona=AZ|arkansas=AR|california=CA|colorado=CO|connecticut=CT|delaware=DE|district of columbia=DC|florida=FL|georgia=GA|hawaii=HI|idaho=ID|illinois=IL|indiana=IN|iowa=IA|kansas=KS
kentucky=KY|louisiana=LA|maine=ME|maryland=MD|massachusetts=MA|michigan=MI|minnesota=MN|mississippi=MS|missouri=MO|montana=MT|nebraska=NE|nevada=NV|new hampshire=NH|new jersey=NJ|new mexico=NM|new york=NY|north carolina=NC
north dakota=ND|ohio=OH|oklahoma=OK|oregon=OR|pennsylvania=PA|rhode island=RI|south carolina=SC|south dakota=SD|tennessee=TN|texas=TX|utah=UT|vermont=VT|virginia=VA|washington=WA|west virginia=WV|wisconsin=WI|wyoming=WY""".replace("\n", "|").split("|")
)
FEATURES = 1 << 15
_STATE = re.compile(r"\(([a-z]{2})\)|,\s*([a-z]{2})$")


def state_of(c: Column) -> Column:
    """The abbreviation of a state, written out or not; null for anything else."""
    t = norm(c)
    by = F.create_map(*[F.lit(x) for kv in STATE_NAMES.items() for x in kv])
    return F.when(t.isin(*[v.lower() for v in STATE_NAMES.values()]), F.upper(t)).otherwise(F.try_element_at(by, t))


def plain(name: str) -> str:
    from wattlake.llm.names import _plain

    return _plain(name).replace(" and ", " ")


def words(name: str) -> list[str]:
    t = _STATE.sub(lambda m: " " if (m[1] or m[2]) in STATES else m[0], name)
    return re.findall(r"[a-z0-9%]+(?:[./][a-z0-9]+)*", t)


def features(name: str) -> list[int]:
    """Hashed words and word parts of a name, without words of payment and groups."""
    t = name
    for rx, _ in GROUPS:
        t = re.sub(rx, " ", t)
    out = set()
    for w in words(t):
        w = w.replace("/", "").replace(".", "")
        if w in PAYMENT or w in JOINING or not w:
            continue
        out.add(w)
        x = f"^{w}$"
        for k in (3, 4, 5):
            out |= {x[i : i + k] for i in range(len(x) - k + 1)}
    return sorted({zlib.crc32(x.encode()) % FEATURES for x in out})


class ProductModel:
    """Naive Bayes from names to products; products' own names and initials count as examples too."""

    def __init__(self, examples: list[tuple[str, str]], weight: int = 5):
        self.products = sorted({p for _, p in examples})
        at = {p: i for i, p in enumerate(self.products)}
        n = np.full((FEATURES, max(1, len(self.products))), 0.05, dtype=np.float32)
        for name, p in examples:
            n[features(name), at[p]] += 1
        for p, i in at.items():
            w = [x for x in re.findall(r"[a-z]+", plain(p)) if x not in JOINING]
            for x in (plain(p), "".join(y[0] for y in w) if len(w) > 1 else "", "".join(y[0] for y in w) + "s" if len(w) > 1 else ""):
                if x:
                    n[features(x), i] += weight
        n /= n.sum(axis=0, dtype=np.float64).astype(np.float32)
        np.log(n, out=n)
        n -= n.mean(axis=1, keepdims=True)
        self.weights = n

    def tell(self, name: str) -> tuple[str, float]:
        """The product of a name and how much surer it is than the next one."""
        if not self.products:
            return "", 0.0
        s = self.weights[features(name)].sum(axis=0)
        o = np.argsort(-s)
        return self.products[o[0]], float(s[o[0]] - s[o[1]]) if len(o) > 1 else 0.0


def group_of(name: str, product: str) -> str:
    """The group of customers that a name states, beyond what its product is called."""
    own = plain(product)
    for rx, g in GROUPS:
        if len(re.findall(rx, name)) > len(re.findall(rx, own)):
            if g == "residential" and not re.search(r"\bres(?:idential)?\b", name) and re.search(r"\bhome\b", name) and not re.search(r"\(home\)|^\w*\s?home\b|, home\b", name):
                continue  # "home" before other words may belong to the product
            return g
    return ""


def vocabulary(rows: DataFrame, least: int = 5, share: float = 1 / 20000) -> dict[str, float]:
    """Words of names that ``least`` organisations use, with the chance that two uses are about the same product (how much they tell of it).

    Counted over all rows; no more words can reach ``share`` of all names than words a name has, divided by it.
    """
    n = rows.count()
    w = rows.select("org", "product", F.explode(F.array_distinct("words")).alias("w")).groupBy("w", "product").agg(F.count("*").alias("n"), F.collect_set(F.pmod(F.xxhash64("org"), F.lit(64))).alias("o"))
    pairs = F.sum(F.col("n") * (F.col("n") - 1)).alias("same")
    w = w.groupBy("w").agg(F.sum("n").alias("n"), pairs, F.size(F.array_distinct(F.flatten(F.collect_list("o")))).alias("orgs"))
    return {r["w"]: r["same"] / (r["n"] * (r["n"] - 1)) for r in w.where((F.col("orgs") >= least) & (F.col("n") >= n * share)).toLocalIterator()}


def read(rows: DataFrame, model: ProductModel) -> DataFrame:
    """Adds product, sure, stated group and words of each row's name. Rows have: side, id, name, org, segment."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        seen: dict[str, tuple] = {}
        for pdf in batches:
            out = []
            for name in pdf["name"]:
                if name not in seen:
                    if len(seen) > 50_000:
                        seen.clear()
                    p = plain(name)
                    product, sure = m.tell(p)
                    seen[name] = (product, sure, group_of(p, product), words(p))
                out.append(seen[name])
            pdf = pdf.assign(product=[x[0] for x in out], sure=[x[1] for x in out], words=[x[3] for x in out])
            pdf["group"] = [s if s else x[2] for s, x in zip(pdf["segment"], out, strict=True)]
            yield pdf

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{schema}, product string, sure double, words array<string>, `group` string")


class Near:
    """Whether a word is a small edit away from one of the words given: two from words of more than six letters, else one.

    By symmetric deletion: words are filed, by hash, under what taking up to two letters out leaves, and only words that
    share such a rest are compared. Built where it is used, once a worker.
    """

    def __init__(self, words_: list[str]):
        self.words = words_

    def __getstate__(self) -> dict:
        return {"words": self.words}

    @staticmethod
    def _rests(w: str, most: int) -> set[str]:
        out = {w}
        for k in range(1, most + 1):
            out |= {"".join(c for i, c in enumerate(w) if i not in cut) for cut in combinations(range(len(w)), k)} if len(w) > k else set()
        return out

    def has(self, w: str) -> bool:
        if "keys" not in self.__dict__:
            filed = [(xxhash.xxh64_intdigest(r), i) for i, x in enumerate(self.words) for r in self._rests(x, 2)]
            keys, at = (np.array(z, t) for z, t in zip(zip(*filed, strict=True), (np.uint64, np.int32), strict=True)) if filed else (np.zeros(0, np.uint64), np.zeros(0, np.int32))
            by = np.argsort(keys, kind="stable")
            self.keys, self.at, self.memo = keys[by], at[by], {}
        if w not in self.memo:
            if len(self.memo) > 100_000:
                self.memo.clear()
            most = 2 if len(w) > 6 else 1
            rests = np.array([xxhash.xxh64_intdigest(r) for r in self._rests(w, most)], np.uint64)
            lo, hi = np.searchsorted(self.keys, rests, "left"), np.searchsorted(self.keys, rests, "right")
            near = {int(i) for a, b in zip(lo, hi, strict=True) for i in self.at[a:b]}
            self.memo[w] = any(edit_distance(w, self.words[i], most) <= most for i in near)
        return self.memo[w]


def marks(rows: DataFrame, vocab: dict[str, float], telling: float = 0.08) -> DataFrame:
    """Adds brand (words many use that tell of no product) and place (words nobody else uses, other than the organisation's own)."""
    shared = rows.sparkSession.sparkContext.broadcast((vocab, Near([w for w in vocab if len(w) >= 4])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, near = shared.value
        own_words = PAYMENT | JOINING | STATES
        for pdf in batches:
            brands, places = [], []
            for ws, org, product in zip(pdf["words"], pdf["org"], pdf["product"], strict=True):
                proper = org.split("|")[0]
                mine = set(re.findall(r"[a-z0-9]+", plain(product)))
                b, p = set(), []
                for w in ws:
                    if w in own_words or w in mine or any(re.fullmatch(rx, w) for rx, _ in GROUPS) or w in ("small", "business", "biz", "low", "income", "qualified", "multi", "family", "home", "res", "comm", "l", "s"):
                        continue
                    if w in v:
                        if v[w] < telling:
                            b.add(w)
                    elif len(w) >= 6 and w.isalpha() and not near.has(w) and edit_distance(w, proper) > 2 and w not in proper:
                        p.append(w)
                brands.append(" ".join(sorted(b)))
                places.append("".join(p))
            yield pdf.drop(columns=["words"]).assign(brand=brands, place=places)

    schema = ", ".join(f"{f.name if f.name != 'group' else '`group`'} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "words")
    return rows.mapInPandas(run, f"{schema}, brand string, place string")


def settle_places(rows: DataFrame, usual: float = 0.5) -> DataFrame:
    """Gives places that differ by a small edit the spelling that more names have; only organisations that put a place in at least ``usual`` of their names have places at all."""
    own = rows.groupBy("org").agg(F.avg((F.col("place") != "").cast("double")).alias("placed"))
    rows = cut_lineage(rows.join(own, "org").withColumn("place", F.when(F.col("placed") >= usual, F.col("place")).otherwise("")).drop("placed"))
    n = rows.where("place <> ''").groupBy("place").agg(F.count_distinct("org", "product", "name").alias("n"))
    near = similar(n.select(F.col("place").alias("proper")))
    a, b = n.toDF("a", "n_a"), n.toDF("b", "n_b")
    more = (F.col("n_b") > F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("b") < F.col("a")))
    to = near.join(a, "a").join(b, "b").where(more & ((F.col("n_a") <= 2) | (F.col("n_b") >= 4 * F.col("n_a")))).groupBy("a").agg(F.max_by("b", F.struct(-F.col("distance"), F.col("n_b"), F.col("b"))).alias("to"))
    return rows.join(to.withColumnRenamed("a", "place"), "place", "left").withColumn("place", F.coalesce("to", "place")).drop("to")


#: What tells a node from another, and of these what an edge may share or contradict.
NODE = ("org", "group", "brand", "place", "product", "sure", "state", "start", "end", "rate", "cluster")
SHARED = ("org", "product", "place", "state", "start", "end", "rate")


def nodes(rows: DataFrame) -> DataFrame:
    """(node, n, *NODE): what the rows share, with how many they are."""
    return rows.select(node_of().alias("node"), *NODE).groupBy("node", *NODE).agg(F.count("*").alias("n"))


def node_of() -> Column:
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in NODE])


def edges(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left, right, n, r_n, cluster, r_cluster, same, weight) of nodes that share a block: organisation, place, group and brand, with the product or with both dates.

    Where one name leaves out the brand, or the place, the block takes the day of the start, or the state and a date or the rate, instead.
    The weight is the summed rarity of what is shared. Blocks are keyed on all of these at once, so a
    hot organisation is split by product, group, brand and place.
    """
    both = left.select("n", *SHARED).unionByName(right.select("n", *SHARED))
    total = F.lit(float(max(1, both.agg(F.sum("n")).first()[0] or 1)))
    each = both.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in SHARED])).alias("x")).select("n", "x.*").where("v <> ''")
    rarity = cut_lineage(each.groupBy("c", "v").agg(F.log(total / F.sum("n")).alias("w")))
    for c in SHARED:  # once a node, not once an edge
        left = left.join(rarity.where(F.col("c") == c).select(F.col("v").alias(c), F.col("w").alias(f"w_{c}")), c, "left")
    left = cut_lineage(left)
    base = ["org", "group", "brand", "place"]
    cols = [*base, "product", "sure", "state", "start", "end", "rate", "cluster", "n"]
    weights = [f"w_{c}" for c in SHARED]
    a = left.select(F.col("node").alias("left"), *[F.col(c) for c in [*cols, *weights]])
    b = right.select(F.col("node").alias("right"), *[F.col(c).alias(c if c == "org" or c == "group" else f"r_{c}") for c in cols])

    def kept(x: DataFrame) -> DataFrame:
        return x.select("left", "right", "same", "n", "r_n", "cluster", "r_cluster", "sure", "r_sure", *weights, "org", *[c for k in ("brand", "product", "place", "state", "start", "end", "rate") for c in (k, f"r_{k}")])

    def meet(x: DataFrame, keys: list[str], same: bool) -> DataFrame:
        """Nodes of both sides that agree in ``keys``."""
        y = b.select("org", "group", *[F.col(f"r_{k}").alias(k) for k in keys], "right", *[f"r_{k}" for k in cols if k not in ("org", "group")])
        return kept(x.join(y, ["org", "group", *keys]).withColumn("same", F.lit(same)))

    by_product = meet(a, ["brand", "place", "product"], True)
    dated = meet(a.where("start is not null and end is not null"), ["brand", "place", "start", "end"], False)
    dated = dated.where((F.col("product") != F.col("r_product")) & (F.least("sure", "r_sure") < 4))
    # one name may leave the brand out; the same day of start then has to speak for it
    bare = meet(a.where("start is not null"), ["place", "product", "start"], True)
    bare = bare.where((F.col("brand") != F.col("r_brand")) & ((F.col("brand") == "") | (F.col("r_brand") == "")))
    # or the place; then the state has to, and a date or the rate
    lost = meet(a.where("state is not null"), ["brand", "product", "state"], True)
    told = (F.col("start") == F.col("r_start")) | (F.col("end") == F.col("r_end")) | (F.col("rate") == F.col("r_rate"))
    lost = lost.where((F.col("place") != F.col("r_place")) & ((F.col("place") == "") | (F.col("r_place") == "")) & F.coalesce(told, F.lit(False)))
    x = by_product.unionByName(dated).unionByName(bare).unionByName(lost)

    def shared(c: str, against: float) -> Column:
        w = F.coalesce(F.col(f"w_{c}"), F.lit(0.0))
        return F.when(F.col(c) == F.col(f"r_{c}"), w).when((F.col(c) != "") & (F.col(f"r_{c}") != ""), -against * w).otherwise(0.0)

    w = F.col("w_org") + F.when(F.col("same"), F.col("w_product")).otherwise(0.0) + shared("start", 0.5) + shared("end", 0.5) + shared("rate", 0.5) + shared("place", 0.0) + shared("state", 2.0)
    return x.select("left", "right", "n", "r_n", "cluster", "r_cluster", "same", w.alias("weight"))


def link(left: DataFrame, right: DataFrame, keep: float = 0.6, rounds: int = 5, eps: float = 0.01) -> DataFrame:
    """(left, right, confidence): the match of each record of ``left`` that has one; of copies in ``right`` the one of the largest id."""
    left, right = (d if "state" in d.columns else d.withColumn("state", F.lit(None).cast("string")) for d in (left, right))
    e = edges(cut_lineage(nodes(left)), cut_lineage(nodes(right)))
    e = e.withColumn("top", F.max("weight").over(Window.partitionBy("left")))  # by a window, as a join would find all edges twice
    e = cut_lineage(e.where((F.col("weight") > 0) & (F.col("weight") >= keep * F.col("top"))).drop("top").withColumn("w", F.col("weight")))
    let_go(e.sparkSession)
    pairs = F.col("n") * F.col("r_n")
    for _ in range(rounds):
        around = e.groupBy("cluster", "r_cluster").agg((F.sum(F.col("w") * pairs) / F.sum(pairs)).alias("near"))
        moved = cut_lineage(e.join(around, ["cluster", "r_cluster"]).withColumn("new", 0.7 * F.col("weight") + 0.3 * F.col("near")).drop("near"))
        change = moved.agg(F.max(F.abs(F.col("new") - F.col("w")) / F.greatest(F.abs("w"), F.lit(1e-9)))).first()[0] or 0.0
        e = moved.withColumn("w", F.col("new")).drop("new")
        if change < eps:
            break
    ids = right.select(node_of().alias("right"), "id").groupBy("right").agg(F.max("id").alias("right_id"))
    one = e.join(ids, "right").groupBy("left").agg(F.max_by("right_id", F.struct("w", "right_id")).alias("right"), F.max("w").alias("w"), F.sum(F.col("r_n") * F.exp(F.col("w") / 4)).alias("all"))
    sure = F.exp(F.col("w") / 4) / F.col("all") / (1 + F.exp(-(F.col("w") - 4) / 2))
    return left.select(F.col("id"), node_of().alias("left")).join(one.select("left", "right", sure.alias("confidence")), "left").select(F.col("id").alias("left"), "right", "confidence")
