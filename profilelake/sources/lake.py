"""The stored tables a query reads."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from profilelake.plans.ingest import Store, ingest
from profilelake.session import configure, fresh_path
from profilelake.sources import fixtures


@dataclass(frozen=True)
class Lake:
    profiles: DataFrame
    bgc_profiles: DataFrame
    floats: DataFrame

    @staticmethod
    def of(store: Store) -> "Lake":
        return Lake(*(store.read(t) for t in ("profiles", "bgc_profiles", "floats")))


_stores: dict[tuple[str, str], Store] = {}


def fixture_store(spark: SparkSession, sf_dir: str) -> Store:
    """A store ingested from the given tables, built once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        configure(spark)
        store = Store(spark, fresh_path(spark, "lake"))
        ingest(store, fixtures.bronze(spark, sf_dir))
        _stores[key] = store
    return _stores[key]


def fixture_lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake.of(fixture_store(spark, sf_dir))
