"""Keyed writes on snapshot tables: upsert, insert-if-absent, link replacement, unseen rows.

Plain parquet has no row-level writes, so each operator returns the next state of a table; a state is
written beside the last one and a pointer is swapped. Keys are compared as they are; a null key
matches nothing. Of several incoming rows of one key the first by ``order`` counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row a key, the first by ``order``.

    An aggregate of the smallest (order, row) with map-side combining, not a window, so a hot key
    isn't sorted in one task. ``order`` must tell rows of a key apart.
    """
    rest = [c for c in rows.columns if c not in keys]
    by = F.struct(*[F.col(o).alias(f"o{i}") if isinstance(o, str) else o.alias(f"o{i}") for i, o in enumerate(order)])
    out = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("__row"))
    return out.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*rows.columns)


def upsert(existing: DataFrame, incoming: DataFrame, key: str | Sequence[str], update: Sequence[str], on_refresh: Sequence[str] = (), refresh: bool = False) -> DataFrame:
    """Existing rows with the ``update`` columns of incoming ones of the same key (nulls too), and the new rows.

    Columns outside ``update`` keep their value, those in ``on_refresh`` take the incoming one only if ``refresh``.
    One full outer join on the key, which may be several columns; a key with a null in it is never the same as another.
    """
    keys = [key] if isinstance(key, str) else list(key)
    take = set(update) | (set(on_refresh) if refresh else set())
    e, i = existing.withColumn("__e", F.lit(True)).alias("e"), incoming.withColumn("__i", F.lit(True)).alias("i")
    new, known = F.col("__e").isNull(), F.col("__i").isNotNull()
    cols = []
    for c in existing.columns:
        if c in keys:
            cols.append(F.coalesce(f"e.{c}", f"i.{c}").alias(c))
        elif c not in incoming.columns:
            cols.append(F.col(f"e.{c}").alias(c))
        else:
            cols.append(F.when(new | (known & F.lit(c in take)), F.col(f"i.{c}")).otherwise(F.col(f"e.{c}")).alias(c))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"e.{k}") == F.col(f"i.{k}"))
    return e.join(i, same, "full_outer").select(*cols)


def insert_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Existing rows and the first incoming row of each key they lack."""
    return existing.unionByName(keep_first(incoming, keys, order).join(existing.select(*keys), list(keys), "left_anti").select(*existing.columns))


def replace_links(existing: DataFrame, new: DataFrame, owner: str, touched: DataFrame | None = None) -> DataFrame:
    """All links of the touched owners replaced by the new ones; owners without new links keep theirs unless named in ``touched``."""
    owners = (touched if touched is not None else new).select(owner).distinct()
    return existing.join(owners, owner, "left_anti").unionByName(new.select(*existing.columns).distinct())


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key was not seen."""
    return rows.join(seen.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def reuse_ids(groups: DataFrame, live: DataFrame, match: str, id_: str, fallback: Column) -> DataFrame:
    """Groups with the id of the live row of the same ``match`` value, else the fallback id."""
    known = live.where(F.col(match).isNotNull()).groupBy(match).agg(F.min(id_).alias("__live"))
    return groups.join(known, match, "left").withColumn(id_, F.coalesce("__live", fallback)).drop("__live")


#: Parts of a snapshot by the hash of its key; an upsert rewrites only those that its keys fall into.
BUCKETS = 32


def _part(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file at once, on whatever file system the path is."""
    jvm = spark._jvm
    fs, tmp = _files(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(tmp), fs.makeQualified(_files(spark, path)[1]), how)


def _parts(spark: SparkSession, folder: str, name: str) -> dict[str, str]:
    """The path of each filled part of a snapshot."""
    fs, p = _files(spark, f"{folder}/{name}.json")
    if not fs.exists(p):
        raise FileNotFoundError(f"{folder}/{name}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_snapshot(df: DataFrame, folder: str, name: str, key: str | None = None, touched: set[int] | None = None) -> None:
    """Write the next state of a table, in parts by its key if one is given, or of its ``touched`` parts beside the others, and swap its pointer.

    Readers of the last state aren't disturbed: what a state replaces is removed when the next one is written.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    if key is None:
        df.write.parquet(f"{path}/__part=0")
    else:
        df.withColumn("__part", _part(key)).repartition("__part").write.partitionBy("__part").parquet(path)
    fs, p = _files(spark, path)
    made = {x.getPath().getName().split("=")[1]: x.getPath().toString() for x in fs.listStatus(p) if x.isDirectory()}
    try:
        last = _parts(spark, folder, name)
    except FileNotFoundError:
        last = {}
    kept = {k: v for k, v in last.items() if not k.startswith("-") and touched is not None and int(k) not in touched}
    gone = [v for k, v in last.items() if k.startswith("-")]
    replaced = {f"-{i}": v for i, v in enumerate(v for k, v in last.items() if not k.startswith("-") and k not in kept)}
    _put(spark, f"{folder}/{name}.json", json.dumps(kept | made | replaced))
    for x in gone:
        f, q = _files(spark, x)
        f.delete(q, True)


def read_snapshot(spark: SparkSession, folder: str, name: str, parts: set[int] | None = None) -> DataFrame:
    """A table as its last state, or some parts of it."""
    at = {k: v for k, v in _parts(spark, folder, name).items() if not k.startswith("-")}
    some = [v for k, v in at.items() if parts is None or int(k) in parts]
    if some:
        return spark.read.parquet(*some)
    return spark.read.parquet(*list(at.values())[:1]).limit(0)


def upsert_snapshot(rows: DataFrame, folder: str, name: str, key: str, update: Sequence[str]) -> None:
    """Upsert rows, one a key, into a snapshot; only the parts their keys fall into are read and written."""
    spark = rows.sparkSession
    rows = rows.where(F.col(key).isNotNull())
    touched = {r[0] for r in rows.select(_part(key)).distinct().collect()}
    try:
        old = read_snapshot(spark, folder, name, touched)
    except FileNotFoundError:
        write_snapshot(rows, folder, name, key)
        return
    if touched:
        write_snapshot(upsert(old, rows, key, update), folder, name, key, touched)


def top_n(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key with their ``rank``; row_number with a limit on it, so Spark keeps no more than ``n`` a key and partition before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def limited(rows: DataFrame, group: str, order: Sequence[Column], limits: dict[str, int]) -> DataFrame:
    """The first rows of each group up to its limit; groups without a limit, and a null group, are whole."""
    most = F.lit(None).cast("int")
    for g, n in limits.items():
        most = F.when(F.col(group) == g, n).otherwise(most)
    some = rows.where(most.isNotNull()).withColumn("__most", most)
    w = Window.partitionBy(group).orderBy(*order)
    kept = some.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= max([0, *limits.values()])).where(F.col("__n") <= F.col("__most"))
    return rows.where(most.isNull()).unionByName(kept.select(*rows.columns))


def fill_keys(rows: DataFrame, key: str, identify: Column) -> DataFrame:
    """Rows whose key is null or empty take the one that ``identify`` gives, the same at every run; then every row has a key."""
    return rows.withColumn(key, F.coalesce(F.when(F.col(key) != "", F.col(key)), identify))
