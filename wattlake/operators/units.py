"""Quantities recorded in different units, brought to common units through a source graph.

A *label* is what a row says about the unit of its quantity: its unit field or, where that says
nothing, the phrase that follows the same number in its text. Labels are the nodes of the graph; two
labels are linked where two sources record the same entity under them. A few labels of each unit are
anchors with a known conversion. For any other label the scale towards resolved ones is estimated
robustly over all linked pairs of sources (median of log ratios, share of ratios that agree, median
residual offset), snapped to the nearest known conversion, and handed on: labels resolved in one round
anchor the next, until a round resolves nothing. Labels that no link reaches are read from the fixed
vocabulary, and what these reach is resolved after them.

Only per-(entity, source, label) medians are joined, never rows, so a hot entity or source costs one row per
label; after that pre-aggregation an entity holds at most as many rows as its sources have labels, so the
joins need no salt.

Nulls: a row without a quantity, or whose label is unknown to vocabulary and graph, has no result. A null
source is one of its own. Repeated rows each keep their own result. Quantities that aren't finite numbers are left out.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattlake.functions.text import norm, program_hash
from wattlake.session import cut_lineage

# Names of units, by common unit and by the factor from "per named unit" to "per common unit".
UNIT_NAMES: dict[str, dict[float, str]] = {
    "percent": {1: "%|percent|pct|pct of cost|percent of cost|percentage points", 100: "fraction|ratio|share of cost|share", 0.1: "per mille|permille|mille|‰", 0.01: "bp|bps|basis point|basis points"},
    "kilowatt": {1: "kw|kilowatt|kilowatts|kw-ac|kw ac|kwac|kw-dc|kw dc", 1000: "w|watt|watts", 0.001: "mw|megawatt|megawatts"},
    "kwh": {1: "kwh|kilowatt-hour|kilowatt-hours|kilowatt hour|kilowatt hours", 0.001: "mwh|megawatt-hour|megawatt-hours|megawatt hour|megawatt hours", 1000: "wh|watt-hour|watt-hours"},
    "mmbtu": {1: "mmbtu|million btu|dth|dekatherm|dekatherms|decatherm", 10: "therm|therms|thm", 1000: "kbtu|thousand btu"},
    "sqft": {1: "sqft|sf|sq ft|ft2|ft²|square foot|square feet", 1 / 10.7639: "sq m|sqm|m2|m²|square metre|square metres|square meter|square meters", 1 / 9: "sq yd|yd2|square yard|square yards"},
    "linear_ft": {1: "linear_ft|lf|lin ft|linear foot|linear feet|foot|feet|ft|foot of run", 1 / 3.28084: "m|metre|metres|meter|meters|linear metre|linear meter|lin m", 1 / 3: "yd|yard|yards|linear yard|lin yd"},
    "ton": {1: "ton|tons|tr|cooling ton|cooling tons|ton of cooling|tons of cooling|ton of refrigeration", 12: "kbtuh|kbtu/h|kbtu/hr|thousand btu per hour|mbh"},
    "year": {1: "year|years|yr|annual|annually|yearly|annum", 12: "month|months|mo|monthly", 4: "quarter|quarters|qtr|quarterly"},
    "unit": {1: "unit|units|each|ea|apiece|piece|item", 1 / 12: "dozen|doz|dz"},
    "port": {1: "port|ports|charging port|charging ports|charger port"},
}
#: Names that anchor the graph; the labels that units give shares and counts themselves belong to them.
ANCHORS = ("percent", "%", "fraction", "kw", "kwh", "mmbtu", "sqft", "linear_ft", "ton", "year", "unit", "port")
# Labels that name no unit.
NO_UNIT = ("", "other", "none", "null", "n/a", "na", "unknown", "varies", "misc", "-", "tbd")
# Words that may follow a unit in a sentence.
TAIL = r"\s+(?:installed|saved|avoided|of capacity|delivered|treated|replaced)$"

_SMALL = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()


def _number_words() -> dict[str, float]:
    """Words of the numbers up to a hundred, with and without a half."""
    out = {w: float(i) for i, w in enumerate(_SMALL)}
    for i, t in enumerate(_TENS):
        out[t] = 20.0 + 10 * i
        out |= {f"{t}-{w}": 20.0 + 10 * i + j for j, w in enumerate(_SMALL[1:10], 1)}
    out |= {"one hundred": 100.0, "a hundred": 100.0}
    return out | {f"{w} and a half": v + 0.5 for w, v in out.items()}


def known_conversions() -> list[float]:
    """Every scale a label may be snapped to."""
    scales = {f * c for by in UNIT_NAMES.values() for f in by for c in (1, 0.01, 0.1, 100)}
    return sorted({round(s, 12) for s in scales})


def _units(spark: SparkSession) -> DataFrame:
    """The fixed vocabulary as a table; about a hundred rows, so it may be broadcast."""
    rows = [(n, u, float(f)) for u, by in UNIT_NAMES.items() for f, names in by.items() for n in names.split("|")]
    return F.broadcast(spark.createDataFrame(rows, "base string, common_unit string, base_scale double"))


def _numbers(spark: SparkSession) -> DataFrame:
    """The fixed words of numbers as a table; about two hundred rows."""
    return F.broadcast(spark.createDataFrame(list(_number_words().items()), "word string, spelled double"))


def _base(label: Column) -> Column:
    """Struct (base, factor) of a label: the name of a unit in it, and what cents and counts ("per 100 sq ft") make of the scale."""
    t = F.trim(F.regexp_replace(F.regexp_replace(label, r"\.", " "), r"\s+", " "))
    base = F.regexp_replace(t, r"^(?:(?:\$|usd|dollars?|cents?|c|¢)\s*(?=/|per |an? ))?(?:/\s*|per |an? |for each |for every |each (?=\S)|every )?", "")
    count = F.coalesce(F.regexp_extract(base, r"^(\d{1,6}) ", 1).try_cast("double"), F.lit(1.0))
    return F.struct(
        F.trim(F.regexp_replace(F.regexp_replace(base, r"^\d{1,6} ", ""), TAIL, "")).alias("base"),
        (F.when(t.rlike(r"^(?:cents?|c|¢)\s*(?:/|per |an? )"), 0.01).otherwise(1.0) / F.when(count > 0, count)).alias("factor"),
    )


def resolve(labels: DataFrame) -> DataFrame:
    """Adds common_unit and scale to a table of labels, null where the vocabulary doesn't hold the label.

    ``scale`` turns a value per labelled unit into one per common unit.
    """
    b = labels.withColumn("__b", _base(F.col("label"))).withColumn("base", F.col("__b.base"))
    b = b.join(_units(labels.sparkSession), "base", "left")
    return b.withColumn("scale", F.col("base_scale") * F.col("__b.factor")).drop("__b", "base", "base_scale")


def _near(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.abs(b) * 1e-6


def _unit_phrases(t: Column, value: Column) -> Column:
    """Labels that the text puts behind the number ``value``, best first.

    A phrase that the end of the text may have cut is offered whole and without its last word.
    """
    phrase = r"(?:per |for each |for every |an? |each |every |/ ?)[^.,;]*(?:sq\. ?ft\.|lin\. ?ft\.)?|each|apiece|annually|yearly|monthly|quarterly"
    rx = F.lit(rf"(?:\$ ?([\d,]*\.?\d+)|([\d,]*\.?\d+) ?(?:cents?|¢)) ?({phrase})([.,;]|$| )")
    hits = F.arrays_zip(*[F.regexp_extract_all(t, rx, i).alias(n) for i, n in enumerate("dcpe", 1)])

    def number(x: Column) -> Column:
        return F.replace(x, F.lit(","), F.lit("")).try_cast("double")

    def read(h: Column) -> Column:
        p = F.regexp_replace(F.trim(h["p"]), TAIL, "")
        less = F.regexp_replace(p, " [^ ]+$", "")
        both = F.when(h["e"] != "", F.array(p)).when(F.length(p) - F.length(less) <= 3, F.array(less)).otherwise(F.array(p, less))
        in_cents = F.transform(both, lambda x: F.concat(F.lit("cents/"), F.regexp_replace(x, r"^(?:per |for each |for every |an? |each (?=\S)|every |/ ?)", "")))
        return F.when(_near(number(h["d"]), value), both).when(_near(number(h["c"]), value), in_cents).when(_near(number(h["c"]) / 100, value), both)

    return F.flatten(F.filter(F.transform(hits, read), lambda x: x.isNotNull()))


def _shares(t: Column) -> Column:
    """Numbers, or their words, that the text gives as a share of something ("30 % of", "thirty percent of"), also where the text ends in it."""
    words = r"\b((?:(?:one|a) hundred|[a-z]+(?:-[a-z]+)?)(?: and a half)?)"
    rx = F.lit(rf"(?:(?<![\d.,])(\d{{1,3}}(?:\.\d+)?)|{words}) ?(?:%|percent\b)(?: of\b| o?$|$)")
    return F.filter(F.concat(F.regexp_extract_all(t, rx, 1), F.regexp_extract_all(t, rx, 2)), lambda x: x != "")


def labelled(rows: DataFrame, id_: str, entity: Column, percent: str, per_unit: str, unit: str, text: str, source: str = "source") -> DataFrame:
    """(id, entity, source, amount, label): each quantity of a row under the label that the row itself gives it.

    The unit field counts first, then the text, and last, for a share above one, the field it stands in.
    """
    spark = rows.sparkSession
    said = norm(F.coalesce(F.col(unit), F.lit("")))
    said = F.when(~said.isin(*NO_UNIT), said)
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < 1e15), c)
    q = rows.select(
        F.col(id_).alias("id"),
        entity.alias("entity"),
        (F.coalesce(F.col(source), F.lit("")) if source in rows.columns else F.lit("")).alias("source"),
        said.alias("said"),
        F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+", " ").alias("t"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("share"), finite(F.col(c).cast("double")).alias("amount")) for k, c in ((True, percent), (False, per_unit))])).alias("q"),
    ).select("id", "entity", "source", "said", "t", "q.share", "q.amount").where("amount is not null")
    plain = q.where("said is not null").select("id", "entity", "source", "amount", F.col("said").alias("label"))
    free = q.where("said is null")
    kind = lambda name, a: F.transform(a, lambda x, i: F.struct(F.lit(name).alias("kind"), i.alias("pos"), x.alias("text")))
    told = F.concat(kind("unit", F.when(F.col("share"), F.array().cast("array<string>")).otherwise(_unit_phrases(F.col("t"), F.col("amount")))), kind("share", _shares(F.col("t"))))
    c = free.select("id", "entity", "source", "amount", "share", F.explode_outer(told).alias("c")).select("*", "c.kind", "c.pos", F.col("c.text").alias("label")).drop("c")
    c = resolve(c).join(_numbers(spark), F.col("label") == F.col("word"), "left")
    number = F.coalesce(F.col("label").try_cast("double"), F.col("spelled"))
    label = (
        F.when((F.col("kind") == "unit") & F.col("common_unit").isNotNull(), F.col("label"))
        .when((F.col("kind") == "share") & _near(F.col("amount"), number), F.lit("percent"))
        .when((F.col("kind") == "share") & _near(F.col("amount") * 100, number), F.lit("fraction"))
    )
    rank = F.struct(label.isNull(), F.col("kind") == "share", "pos")
    best = c.groupBy("id", "entity", "source", "amount", "share").agg(F.min_by(label, rank).alias("label"))
    best = best.withColumn("label", F.coalesce("label", F.when(F.col("share") & (F.col("amount") > 1), F.lit("percent")))).drop("share")
    return plain.unionByName(best).where("label is not null")


def _observed(q: DataFrame) -> DataFrame:
    """(entity, source, label, amount, n): what each source records of an entity under each label. Without sources each label is one."""
    d = q if "source" in q.columns else q.withColumn("source", F.col("label"))
    d = d.withColumn("source", F.when(F.col("source") == "", F.col("label")).otherwise(F.col("source")))
    return d.groupBy("entity", "source", "label").agg(F.percentile_approx("amount", 0.5, 10000).alias("amount"), F.count("*").alias("n"))


def _estimated(ratio: DataFrame, keys: list[str], conversions: list[float]) -> DataFrame:
    """(*keys, scale, off, support, share, offset, size): from pairs (amount, ref) the median ratio, or the known conversion if one lies within the tolerance, how far off the nearest one is, how many pairs bear it, and the median residual."""
    known = F.array(*[F.lit(x) for x in conversions])
    r = ratio.withColumn("r", F.log(F.col("ref") / F.col("amount")))
    edge = r.groupBy(*keys).agg(F.count("*").alias("support"), F.percentile_approx("r", 0.5, 10000).alias("m"))
    snapped = F.array_min(F.transform(known, lambda k: F.struct(F.abs(F.log(k) - F.col("m")).alias("off"), k.alias("scale"))))
    edge = edge.select(*keys, "support", "m", snapped.alias("s")).select(*keys, "support", "s.off", F.when(F.col("s.off") <= TOLERANCE, F.col("s.scale")).otherwise(F.exp("m")).alias("scale"))
    return r.join(edge, keys).groupBy(*keys, "scale", "off", "support").agg(
        F.avg((F.abs(F.col("r") - F.log("scale")) <= TOLERANCE).cast("double")).alias("share"),
        F.percentile_approx(F.col("ref") - F.col("scale") * F.col("amount"), 0.5, 10000).alias("offset"),
        F.percentile_approx("ref", 0.5, 10000).alias("size"),
    )


#: How far a ratio may be from a known conversion, in logarithms, and a residual offset from nothing, by size.
TOLERANCE = 0.01


def source_edges(q: DataFrame) -> DataFrame:
    """(source_a, label_a, source_b, label_b, scale, offset, support, share): the links between labels of two sources and what turns a value of the first into one of the second."""
    by = _observed(q).where("amount > 0")
    a = by.select("entity", F.col("source").alias("source_a"), F.col("label").alias("label_a"), "amount")
    b = by.select("entity", F.col("source").alias("source_b"), F.col("label").alias("label_b"), F.col("amount").alias("ref"))
    pairs = a.join(b, "entity").where("source_a < source_b")
    both_ways = sorted({round(x, 12) for k in known_conversions() for x in (k, 1 / k)})
    return _estimated(pairs, ["source_a", "label_a", "source_b", "label_b"], both_ways).select("source_a", "label_a", "source_b", "label_b", "scale", "offset", "support", "share")


def label_graph(q: DataFrame, min_support: int = 3, agreement: float = 0.6, anchors: tuple[str, ...] = ANCHORS) -> DataFrame:
    """(label, common_unit, scale, round): what each label converts to.

    Round 0 are the anchors. In each further round, until one resolves nothing, a label is linked, by the entities that other
    sources record under resolved labels, to the unit most of them have; its scale is the median ratio, and it
    is taken if a known conversion lies within the tolerance, ``min_support`` links bear it and
    ``agreement`` of the ratios lie within the tolerance of it. Labels no link reaches are read from the vocabulary (round -1).
    """
    by = cut_lineage(_observed(q))
    labels = by.groupBy("label").agg(F.sum("n").alias("rows"))
    named = _base(F.col("label"))
    read = resolve(labels).where("scale is not null").select("label", "common_unit", "scale", (named["base"].isin(*anchors) & (named["factor"] == 1)).alias("anchor"))
    read = cut_lineage(read)
    done = read.where("anchor").select("label", "common_unit", "scale", F.lit(0).alias("round"))
    rest = read.where("not anchor").select("label", "common_unit", "scale", F.lit(-1).alias("round"))
    last = False
    for i in count(1):
        refs = by.join(done, "label").groupBy("entity", F.col("source").alias("other"), "common_unit").agg(F.percentile_approx(F.col("amount") * F.col("scale"), 0.5, 10000).alias("ref"))
        free = by.join(done, "label", "left_anti").where("amount > 0")
        close = _estimated(free.join(refs, "entity").where("source <> other and ref > 0"), ["label", "common_unit"], known_conversions())
        fits = (F.col("support") >= min_support) & (F.col("off") <= TOLERANCE) & (F.col("share") >= agreement) & (F.abs("offset") <= TOLERANCE * F.col("size"))
        best = close.where(fits).groupBy("label").agg(F.max_by(F.struct("common_unit", "scale"), F.struct("support", "share", "common_unit")).alias("b"))
        found = cut_lineage(best.select("label", "b.common_unit", "b.scale", F.lit(i).alias("round")))
        if found.isEmpty():
            if last:
                break
            last, found = True, rest.join(done, "label", "left_anti")
            if found.isEmpty():
                break
        done = cut_lineage(done.unionByName(found))
    return done


def harmonise(
    rows: DataFrame, id_: str = "id", name: str = "program_name", organisation: str = "utility_company", percent: str = "percent_value",
    per_unit: str = "per_unit_amount", unit: str = "unit_type", text: str = "incentive_description", learn: bool = True, **graph
) -> DataFrame:
    """(id, common_unit, value): each quantity of a row in its common unit; by the vocabulary alone unless ``learn``."""
    q = cut_lineage(labelled(rows, id_, program_hash(name, organisation), percent, per_unit, unit, text))  # for its labels, and for itself
    if learn:
        g = label_graph(q, **graph).select("label", "common_unit", "scale")
    else:
        g = resolve(q.select("label").distinct()).where("scale is not null").select("label", "common_unit", "scale")
    return q.join(g, "label").select("id", "common_unit", (F.col("amount") * F.col("scale")).alias("value"))
