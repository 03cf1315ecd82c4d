"""Sources: landed payloads to rows. Transport (requests, browsers, schedules) is outside the engine."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wattlake.functions.urls import is_pdf, keep_url
from wattlake.operators.staging import keep_first


@dataclass(frozen=True)
class Source:
    """A named source: how its landed files are read and turned into rows."""

    name: str
    read: Callable[[SparkSession, str], DataFrame]
    extract: Callable[[DataFrame], DataFrame] = field(default=lambda d: d)


class Registry:
    """Sources by name. A source whose files can't be read is left out of a union and reported."""

    def __init__(self) -> None:
        self.sources: dict[str, Source] = {}

    def add(self, source: Source) -> Source:
        self.sources[source.name] = source
        return source

    def union(self, spark: SparkSession, folders: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
        parts, failed = [], {}
        for name, folder in folders.items():
            try:
                s = self.sources[name]
                parts.append(s.extract(s.read(spark, folder)).withColumn("source", F.lit(name)))
            except Exception as e:  # a failing source must not stop the others
                failed[name] = str(e)[:500]
        if not parts:
            raise ValueError(f"no source could be read: {failed}")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), failed


def json_pages(spark: SparkSession, path: str, schema: str, items: str) -> DataFrame:
    """Landed pages of an API, one JSON document a file, exploded into the rows of their list ``items`` with their page and position."""
    d = spark.read.schema(schema).option("multiLine", True).json(path).select(F.col("_metadata.file_name").alias("page"), F.posexplode(items).alias("pos", "item"))
    return d.select("page", (F.col("pos") + 1).alias("pos"), "item.*")


def paged_rows(spark: SparkSession, path: str, schema: str, items: str, number: str) -> DataFrame:
    """Landed pages of an API, one JSON document a line, exploded into the rows of their list ``items`` with the page's own ``number`` and their position."""
    d = spark.read.schema(schema).json(path).select(F.col(number).alias("page"), F.posexplode(items).alias("pos", "item"))
    return d.select("page", (F.col("pos") + 1).alias("pos"), "item.*")


def merge_pages(rows: DataFrame, key: str) -> DataFrame:
    """The first row of each key in the order of pages and positions, however the pages arrived; a page that failed leaves the others whole."""
    return keep_first(rows, [key], ["page", "pos"])


def retry_blocked(fetched: DataFrame, again: DataFrame, key: str, status: str, blocked: Sequence[int] = (401, 403, 407)) -> DataFrame:
    """Fetched rows, those that were blocked replaced by what a second way brought; a key that neither way brought is left out, and each key comes once."""
    ok = fetched.where(~F.col(status).isin(*blocked))
    missing = fetched.where(F.col(status).isin(*blocked)).select(key).distinct().join(ok.select(key), key, "left_anti")
    return ok.unionByName(again.join(missing, key, "left_semi").where(~F.col(status).isin(*blocked)).select(*ok.columns)).dropDuplicates([key])


def newest(rows: DataFrame, addresses: Sequence[str], time: str, id_: str) -> DataFrame:
    """(address, *columns): for each address the newest row that bears it in any of the columns, as one equi-key instead of a join on either."""
    a = F.array_distinct(F.array(*[F.when(F.col(c) != "", F.col(c)) for c in addresses]))
    x = rows.select(F.explode(a).alias("address"), *rows.columns).where("address is not null")
    return keep_first(x, ["address"], [F.col(time).isNull(), -F.unix_micros(F.coalesce(time, F.lit(0).cast("timestamp"))), id_])


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def csv_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of a CSV file as text; header names in any case, rows of a wrong shape dropped."""
    d = spark.read.option("header", True).option("mode", "DROPMALFORMED").option("quote", '"').option("escape", '"').csv(path)
    d = d.toDF(*[c.strip().strip('"').lower() for c in d.columns])
    return d.select(*[F.col(c) if c in d.columns else F.lit(None).cast("string").alias(c) for c in columns])


def postal_codes(spark: SparkSession, path: str, states: DataFrame) -> DataFrame:
    """(state, zip, population) of the tabulated, non-military codes of the given states; a bad population counts 0."""
    d = csv_rows(spark, path, ["zip", "state_id", "zcta", "military", "population"])
    yes = lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))).isin("true", "1", "yes")
    d = d.where((F.trim("zip") != "") & yes(F.col("zcta")) & ~yes(F.col("military")))
    d = d.select(F.upper(F.trim("state_id")).alias("state"), F.trim("zip").alias("zip"), F.coalesce(F.col("population").try_cast("int"), F.lit(0)).alias("population"))
    return d.join(states.select(F.col("abbr").alias("state")), "state", "left_semi")


def _locations(spark: SparkSession, path: str, tag: str) -> DataFrame:
    d = spark.read.format("xml").option("rowTag", tag).schema(T.StructType([T.StructField("loc", T.StringType())])).load(path)
    return d.select(F.trim("loc").alias("loc")).where("loc <> ''").distinct()


def sitemap_urls(spark: SparkSession, path: str, depth: int = 3) -> DataFrame:
    """(loc) of the addresses in landed sitemap files; files that aren't a sitemap give none.

    An index of sitemaps is followed to the files it names, which have landed too, ``depth`` levels down; names that haven't landed give none.
    """
    out, seen, level = None, set(), [path]
    for i in range(depth + 1):
        urls = reduce(DataFrame.unionByName, [_locations(spark, p, "url") for p in level])
        out = urls if out is None else out.unionByName(urls)
        if i == depth:
            break
        seen |= set(level)
        # an index names at most 50 000 files by its own rules, and a site has few indexes
        named = {r[0] for p in level for r in _locations(spark, p, "sitemap").collect()} - seen
        level = [p for p in sorted(named) if _exists(spark, p)]
        if not level:
            break
    return out.distinct()


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    except Exception:  # an address of another kind
        return False


def pick_urls(urls: DataFrame, seeds: DataFrame, exclude: list[str], include: list[str], depth: int, limit: int | None = None) -> DataFrame:
    """(loc, is_pdf) of the addresses that pass the filter, or of the seeds if none does."""
    kept = urls.where(keep_url(F.col("loc"), exclude, include, depth)).distinct()
    kept = kept if not kept.isEmpty() else seeds.select("loc").distinct()
    kept = kept.withColumn("is_pdf", is_pdf(F.col("loc")))
    return kept.orderBy("loc").limit(limit) if limit else kept


def join_pages(pages: DataFrame, file: str, page: str, text: str, ranges: list[tuple[int, int]] | None = None, mark: str = "\n\n--- page break ---\n\n") -> DataFrame:
    """(file, text) of the wanted pages of each file in order; no ranges means all pages; null pages are skipped.

    A file's pages are one value of the result, so they must fit a row; pages are shuffled, not files.
    """
    wanted: Column = F.lit(ranges is None)
    for a, b in ranges or []:
        wanted = wanted | F.col(page).between(a, b)
    d = pages.where(wanted & F.col(text).isNotNull()).groupBy(file).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t")))).alias("x"))
    return d.select(file, F.array_join(F.transform("x", lambda x: x["t"]), mark).alias("text"))


def wanted_sources(subscribers: DataFrame, rows: DataFrame) -> DataFrame:
    """(source): what the active subscribers want, and all sources of ``rows`` if one of them names none."""
    active = subscribers.where(F.coalesce("active", F.lit(False)))
    named = active.select(F.explode("sources").alias("source")).where("source is not null").distinct()
    if active.where((F.size("sources") <= 0) | F.col("sources").isNull()).isEmpty():
        return named
    return named.unionByName(rows.select("source").where("source is not null")).distinct()


def dispatch(rows: DataFrame, kinds: Sequence[tuple[Column, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Stored payloads extracted again: each row by the first kind whose condition holds; rows of no kind are left out."""
    left = F.lit(True)
    parts = []
    for holds, extract in kinds:
        on = F.coalesce(holds, F.lit(False))
        parts.append(extract(rows.where(left & on)))
        left = left & ~on
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_details(rows: DataFrame, details: DataFrame, key: str, text: str, more: str, take: Sequence[str]) -> DataFrame:
    """Rows with what their detail pages add: ``take`` where the row has nothing, and the text ``more`` behind their own."""
    d = details.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in (*take, more)]).dropDuplicates([key])
    x = rows.join(d, key, "left")
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    said = F.concat_ws("\n\n", blank(text), blank(f"__{more}"))
    new = {c: F.coalesce(blank(c), F.col(f"__{c}")) for c in take} | {text: F.when(said != "", said)}
    return x.withColumns(new).select(*rows.columns)
