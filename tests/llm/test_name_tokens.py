"""Names whose tokens are reordered, misspelt each, or given by initials."""

import pytest

from wattlake.llm import names


def _pairs(spark, raw):
    d = spark.createDataFrame([(x,) for x in raw], "x string")
    return {tuple(r) for r in names.pairs(names.organisations(names.distinct_names([d]))).collect()}


@pytest.mark.parametrize(
    ("a", "b", "linked"),
    [
        ("cedar falls electric company", "falls cedar electric company", True),
        ("cedarbrook, north gas company", "north cedarbrook gas company", True),
        ("cedarbrook grandvalley gas company", "cedarbrok grandvally gas company", True),
        ("cedarbrooks grandvalleys gas company", "grandvalyes cedarborks gas company", True),
        ("c. grandvalley gas company", "cedarbrook grandvalley gas company", True),
        ("north cedarbrook gas company", "upper cedarbrook gas company", False),
        ("north cedarbrook gas company", "cedarbrook gas company", False),
        ("cedar falls electric company", "falls cedar gas company", False),
    ],
)
def test_two_names(spark, a, b, linked):
    assert _pairs(spark, [a, b]) == ({tuple(sorted((a, b)))} if linked else set())


def test_well_attested_orders_are_one(spark):
    raw = [f"{n} {k}" for n in ("cedar falls", "falls cedar") for k in ("electric company", "elec co", "electric co.", "electric company inc")]
    assert len(_pairs(spark, raw)) == 28


def test_bare_acronym(spark):
    assert _pairs(spark, ["bgc", "bgc (brenavale gas company)"]) == {("bgc", "bgc (brenavale gas company)")}
    assert ("brea", "brenavale rural electric association") in _pairs(spark, ["brea", "brenavale rural electric association"])
    assert _pairs(spark, ["brea", "brenavale rural electric association", "bolinger rural electric association"]) == set()


def test_short_names(spark):
    assert _pairs(spark, ["ge power company", "power company of ge", "ge", "n/a", "na", "n/a gas company"]) == {("ge power company", "power company of ge")}
