"""Filling containers of fixed capacity by sum-of-squares online packing.

An item is placed into the open container at the fill level that minimises the sum over levels of
the squared number of containers standing at that level; a new container is level 0, a full one
leaves the account. The state is one array of counts by level, so a placement costs one vector
operation over the levels.

Items are dealt by a hash of their key to shards of about ``shard_items``; every shard is packed on
its own, so no task holds more than a shard and the loss against one large packing is one set of
open containers a shard. An item larger than the capacity is split: full containers of its own
first, its rest is an item like any other. Items without size (null, empty or negative) have no
piece. Equal items are packed each. An empty table packs to nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wattlake.session import cut_lineage


#: Most kinds of containers that one call packs for.
MOST_KINDS = 100


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container number of each item, in the order given; sizes from 1 to ``capacity``."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), dtype=np.int64)
    n = 0
    for i, s in enumerate(sizes.tolist()):
        if s == capacity:
            out[i], n = n, n + 1
            continue
        new_cost = 2 * counts[s] + 1
        best, level = new_cost, 0
        if capacity - s >= 1:
            frm = counts[1 : capacity - s + 1]
            cost = 2 * (counts[1 + s : capacity + 1] - frm) + 2
            cost[-1] = 1 - 2 * frm[-1]  # a full container leaves the account
            cost = np.where(frm > 0, cost, np.iinfo(np.int64).max)
            k = int(np.argmin(cost))
            if cost[k] <= new_cost:
                best, level = cost[k], k + 1
        if level:
            counts[level] -= 1
            c = open_at[level].pop()
        else:
            c, n = n, n + 1
        out[i] = c
        if level + s < capacity:
            counts[level + s] += 1
            open_at[level + s].append(c)
    return out


def pack(items: DataFrame, id_: str, size: str, containers: DataFrame, container: str = "container", capacity: str = "capacity", shard_items: int = 50_000) -> DataFrame:
    """(container, id, piece_no, size, bin): each piece with the container it lies in.

    ``containers`` is a small table (kind, capacity); every kind is packed with all items. ``bin`` is
    ``shard-number``. Pieces count from 1 in the order of the text.
    """
    items = cut_lineage(items.select(F.col(id_).alias("__id"), F.col(size).cast("bigint").alias("__size")).where("__id is not null and __size > 0"))
    n = items.count()
    shards = max(1, math.ceil(n / shard_items))
    kind = items.schema["__id"].dataType.simpleString()
    kinds = containers.select(F.col(container).alias("container"), F.col(capacity).cast("bigint").alias("cap")).where("container is not null and cap > 0").distinct()
    # kinds are a configuration of a few rows, which is checked: each item is repeated once a kind
    known = kinds.limit(MOST_KINDS + 1).collect()
    if len(known) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of containers")
    each = F.array(*[F.struct(F.lit(r["container"]).alias("container"), F.lit(r["cap"]).alias("cap")) for r in known]) if known else F.array().cast("array<struct<container:string,cap:bigint>>")
    both = items.withColumn("shard", F.pmod(F.xxhash64("__id"), F.lit(shards)).cast("int")).withColumn("k", F.explode(each)).select("*", "k.*").drop("k")

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name, shard = key
        cap = int(pdf["cap"].iloc[0])
        pdf = pdf.sort_values(["mix", "__id"], kind="stable")
        size_ = pdf["__size"].to_numpy()
        ids = pdf["__id"].to_numpy()
        full, rest = size_ // cap, size_ % cap
        has = rest > 0
        bins = np.full(len(size_), -1, dtype=np.int64)
        bins[has] = sum_of_squares(rest[has], cap)
        free = int(bins.max()) + 1 if has.any() else 0
        whole = np.repeat(np.arange(len(ids)), full)
        within = np.arange(len(whole)) - np.repeat(np.cumsum(full) - full, full)
        out = pd.concat(
            [
                pd.DataFrame({"id": ids[whole], "piece_no": within + 1, "size": cap, "n": free + np.arange(len(whole))}),
                pd.DataFrame({"id": ids[has], "piece_no": full[has] + 1, "size": rest[has], "n": bins[has]}),
            ]
        )
        out.insert(0, "container", name)
        out["bin"] = f"{shard}-" + out.pop("n").astype(str)
        return out

    schema = f"container string, id {kind}, piece_no int, size bigint, bin string"
    return both.withColumn("mix", F.xxhash64("__id", F.lit(7))).groupBy("container", "shard").applyInPandas(one, schema)


def fill_report(pieces: DataFrame, containers: DataFrame, container: str = "container", capacity: str = "capacity") -> DataFrame:
    """(container, capacity, bins, pieces, filled): how full the containers of each kind are."""
    kinds = containers.select(F.col(container).alias("container"), F.col(capacity).alias("capacity")).distinct()
    by_bin = pieces.groupBy("container", "bin").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    r = by_bin.groupBy("container").agg(F.count("*").alias("bins"), F.sum("n").alias("pieces"), F.sum("size").alias("size"))
    return r.join(kinds, "container").select("container", "capacity", "bins", "pieces", (F.col("size") / (F.col("bins") * F.col("capacity"))).alias("filled"))
