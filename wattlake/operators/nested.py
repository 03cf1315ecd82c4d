"""Deeply nested records to flat child tables, in one pass.

One projection visits a record depth first and emits an array of tagged items
``(tag, parent_key, set_no, item_no, payload)``; a single ``explode`` turns it into rows. All child
tables come out of one scan and no shuffle is needed until repeats of a parent are merged. The rows
can be written once, partitioned by tag, and each tag read back under its own schema.

Nulls: a null record, list or element has no items, but null elements keep their place in the
numbering. An element of JSON without any non-blank content is no item either, nor is a typed element
whose fields are all null; fields that are there but blank make one. Text that isn't whole JSON,
after its carrier (byte order mark, anti-hijacking prefix, HTML escaping, JSON string) is taken off,
has no items. A parent key that is null is kept as a key of its own and yields no child rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

ITEM = T.StructType(
    [
        T.StructField("child", T.StringType()),
        T.StructField("parent_key", T.StringType()),
        T.StructField("set_no", T.IntegerType()),
        T.StructField("item_no", T.IntegerType()),
        T.StructField("payload", T.StringType()),
    ]
)


@dataclass(frozen=True)
class JsonChild:
    """A child list of a JSON object: ``path`` from the root, and lists nested in its items."""

    tag: str
    field: str
    inner: tuple[tuple[str, str], ...] = ()


ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&"))


def take_off_carrier(c: Column) -> Column:
    """JSON text without what a carrier put around it; text that is JSON already is left as it is."""
    t = F.regexp_replace(c, r"^[\s\x{FEFF}]*(?:\)\]\}'[,;]?\s*|while\s*\(1\)\s*;\s*|for\s*\(;;\)\s*;\s*)?", "")
    t = F.regexp_replace(t, r"[\s\x{FEFF}\x{0}]+$", "")
    inner = F.get(F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>"), F.lit(0))
    t = F.when(t.startswith('"') & t.endswith('"'), inner).otherwise(t)
    un = t
    for a, b in ENTITIES:
        un = F.replace(un, F.lit(a), F.lit(b))
    return F.when(t.rlike(r"^[\[{]\s*&(?:quot|#34);"), un).otherwise(t)


def _is_content(v: Column) -> Column:
    """Whether a variant has content: any non-blank string, number or boolean in it."""
    j = F.to_json(v)
    bare = F.regexp_replace(F.regexp_replace(j, r'"[^"\\]*"\s*:', ""), r'null|[\s{}\[\]",]', "")
    return F.coalesce(j.isNotNull() & (bare != ""), F.lit(False))


def _items(v: Column, path: str) -> Column:
    """The elements under ``path`` as an array of variants: a list's own, or the one object or text in place of a list."""
    one = F.try_variant_get(v, path, "variant")
    many = F.try_variant_get(v, path, "array<variant>")
    return F.coalesce(many, F.when(one.isNotNull() & ~F.is_variant_null(one), F.array(one)), F.array().cast("array<variant>"))


def _tagged(tag: Column, key: Column, set_no: Column, pos: Column, payload: Column) -> Column:
    return F.struct(
        tag.alias("child"), key.cast("string").alias("parent_key"), set_no.cast("int").alias("set_no"), pos.cast("int").alias("item_no"), payload.alias("payload")
    )


def json_children(df: DataFrame, key: str, text: str, children: tuple[JsonChild, ...]) -> DataFrame:
    """Items of ``children`` in the JSON ``text`` of each row, tagged, in one pass."""
    df = df.select(F.col(key).alias("__key"), F.try_parse_json(take_off_carrier(F.col(text))).alias("__v"))
    k = F.col("__key")

    def item(tag: str, set_no, pos, x: Column) -> Column:
        return F.when(_is_content(x), _tagged(F.lit(tag), k, set_no, pos + 1, F.to_json(x)))

    def own(c: JsonChild, items: Column) -> Column:
        return F.transform(items, lambda x, i: item(c.tag, F.lit(0), i, x))

    def nested(tag: str, field: str, items: Column) -> Column:
        return F.flatten(F.transform(items, lambda x, i: F.transform(_items(x, f"$.{field}"), lambda y, j: item(tag, i + 1, j, y))))

    parts = []
    for c in children:
        items = _items(F.col("__v"), f"$.{c.field}")
        parts += [own(c, items), *(nested(tag, field, items) for tag, field in c.inner)]
    return _emit(df.where(k.isNotNull() & F.col("__v").isNotNull()), parts)


def struct_children(df: DataFrame, key: str, sets: str, lists: dict[str, str]) -> DataFrame:
    """Items of the typed lists ``field -> tag`` nested in the elements of ``sets``, tagged, in one pass."""
    kind = df.schema[sets].dataType
    k = F.col("__key")
    df = df.select(F.col(key).alias("__key"), F.col(sets).alias("__sets")).where(k.isNotNull() & F.col("__sets").isNotNull())

    def nested(field: str, tag: str) -> Column:
        names = kind.elementType[field].dataType.elementType.names

        def item(i: Column, x: Column, j: Column) -> Column:
            filled = F.lit(False)
            for n in names:
                filled = filled | x[n].isNotNull()
            return F.when(filled, _tagged(F.lit(tag), k, i + 1, j + 1, F.to_json(x)))

        return F.flatten(
            F.transform("__sets", lambda s, i: F.coalesce(F.transform(s[field], lambda x, j: item(i, x, j)), F.array().cast(T.ArrayType(ITEM))))
        )

    return _emit(df, [nested(field, tag) for field, tag in lists.items()])


def _emit(df: DataFrame, parts: list[Column]) -> DataFrame:
    return df.select(F.explode(F.concat(*parts)).alias("i")).where("i is not null").select("i.*")


def merge_repeats(items: DataFrame) -> DataFrame:
    """One row for each child position of a parent, however often the parent was delivered.

    Of several payloads the smallest is taken, so the result doesn't depend on the order of rows.
    """
    return items.groupBy("child", "parent_key", "set_no", "item_no").agg(F.min("payload").alias("payload"))


def write_tagged(items: DataFrame, path: str) -> None:
    """All child tables in one write, one folder a tag."""
    items.write.mode("overwrite").partitionBy("child").parquet(path)


def read_tag(spark, path: str, tag: str, schema: str) -> DataFrame:
    """The child table ``tag`` with its payload under ``schema``."""
    rows = spark.read.parquet(path).where(F.col("child") == tag)
    return rows.select("parent_key", "set_no", "item_no", F.from_json("payload", schema).alias("p")).select("parent_key", "set_no", "item_no", "p.*")
