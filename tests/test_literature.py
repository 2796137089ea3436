"""Literature predicates, query strings and nutrient bases."""

import pytest

from tessera.functions import literature as L


@pytest.mark.parametrize(
    "label,want",
    [("kg P2O5 ha-1", ("oxide", "P2O5")), ("P₂O₅", ("oxide", "P2O5")), ("potassium oxide", ("oxide", "K2O")), ("potash", ("ambiguous", None)), ("ap (mg/kg)", ("unknown", None)), ("Phosphorus", ("elemental", "P")), ("", ("unknown", None)), (None, ("unknown", None))],
)
def test_basis(label, want):
    assert L.basis(label) == want


def test_queries():
    assert L.boolean_queries(["field trial"], ["zinc", "soil ph"]) == ['"field trial" AND (zinc OR "soil ph")']
    assert L.simple_queries(["rcbd"], ["wheat"]) == ["rcbd AND wheat"]


def test_belongs_to(spark):
    from pyspark.sql import functions as F

    s = spark.createDataFrame([(1, None, "Effect of zinc on wheat yield"), (2, "doi:10.1234/a", None), (3, None, None), (9, None, None)], "id int, doi string, title string")
    p = spark.createDataFrame([(5, "10.1234/A", "x"), (6, None, "Effect of zinc on wheat yields"), (9, None, None)], "id int, doi string, title string")
    assert sorted(tuple(r) for r in L.belongs_to(s, p, F.substring("title", 1, 8)).collect()) == [(1, 6), (2, 5), (9, 9)]


def test_belongs_to_meets_titles_that_differ_at_the_start(spark):
    s = spark.createDataFrame([(1, None, "An effect of zinc on wheat yield in the field"), (2, None, "Zinc!"), (3, None, None)], "id int, doi string, title string")
    p = spark.createDataFrame([(7, None, "The effect of zinc on wheat yield in the fields"), (5, None, "En effect of zinc on wheat yield in the field"), (8, None, "zinc"), (6, None, "ZINC")], "id int, doi string, title string")
    assert sorted(tuple(r) for r in L.belongs_to(s, p).collect()) == [(1, 5), (2, 6)]
