"""Connectors over landed files: a registry and its reader; nothing is fetched from a network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CONNECTORS: dict[str, dict] = {}


def register(name: str, pattern: str, schema: str) -> None:
    """A connector: the files it landed (a glob below the landing folder) and its record schema."""
    CONNECTORS[name] = {"pattern": pattern, "schema": schema}


def load(spark: SparkSession, name: str, landing: str) -> DataFrame:
    """Records (JSON lines) of a connector's files in the landing folder, on any file system; none where no file has landed.

    A line that is no record, or whose fields have other types, fails the read.
    """
    c = CONNECTORS[name]
    return spark.read.schema(c["schema"]).option("pathGlobFilter", c["pattern"]).option("mode", "FAILFAST").json(landing)


# Records of literature and dataset providers share two shapes.
LITERATURE = "source string, source_id string, doi string, title string, abstract string, year int, journal string, publisher string, publication_type string, citations int"
DATASET = "source string, resource string, latitude double, longitude double, date string, variable string, value double, unit string"
for _name in "agris arxiv crossref datacite dimensions doaj europepmc figshare mendeley_papers openalex pubmed scopus semanticscholar wos zenodo_papers".split():
    register(_name, f"{_name}*.jsonl", LITERATURE)
for _name in "cgiar faostat huggingface icar isric kaggle mendeley power sau soilgrids zenodo chirps dataverse gbif gee geoglam gyga mapspam nass worldbank era5".split():
    register(_name, f"{_name}*.jsonl", DATASET)
