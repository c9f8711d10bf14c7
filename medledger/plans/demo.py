"""Claims lake over one data folder, each table stored on first use and shared by later queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fixtures.claims import StarSource, dirtied
from medledger.operators.cleaning import repeated_signatures
from medledger.operators.staging import stage
from medledger.plans.pipeline import marts_on_use, staged_models
from medledger.plans.summaries import build_summaries
from medledger.quality import engine
from medledger.session import tune, work_root
from medledger.sources.lake import Lake, OnUse
from medledger.sources.schemas import RAW_TABLES

_LAKES: dict[tuple[str, str], "ClaimsLake"] = {}


class ClaimsLake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        tune(spark)
        self.spark = spark
        self.source = StarSource(spark, sf_dir)
        name = sf_dir.rstrip("/").split("/")[-1]
        self.lake = Lake(spark, f"{work_root(spark)}/{name}-{len(_LAKES)}")

    @cached_property
    def tables(self) -> OnUse:
        """Raw tables, each stored when it is first asked for."""
        return OnUse(RAW_TABLES, lambda t: self.lake.replace("raw", t, self.source.table(t)))

    @cached_property
    def star(self) -> OnUse:
        """Dimensions and facts, each stored, with what it builds on, when it is first asked for."""
        return marts_on_use(self.lake, self.tables)

    @cached_property
    def repeated(self) -> DataFrame:
        """The signatures that more than one staged header has, stored for the queries on cleaned claims."""
        return self.lake.replace("work", "repeated_in_queries", repeated_signatures(self.staged("claims_header")))

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        """All raw tables, stored."""
        return dict(self.tables)

    @cached_property
    def marts(self) -> dict[str, DataFrame]:
        """All dimensions and facts, stored."""
        _ = self.raw
        return dict(self.star)

    @cached_property
    def summaries(self) -> dict[str, DataFrame]:
        return build_summaries(self.lake, self.star)

    @cached_property
    def quality(self) -> engine.QualityRun:
        return engine.run(self.lake, self.tables)

    @cached_property
    def quality_history(self) -> DataFrame:
        """Two stored runs of all rules: over the raw tables, then over tables on which every rule fails somewhere."""
        _ = self.quality
        engine.run(self.lake, dirtied(self.raw))
        return self.lake.read("dq", "dq_results")

    def staged(self, table: str) -> DataFrame:
        return stage(table, self.tables[table])

    def models(self) -> dict[str, DataFrame]:
        marts = self.marts
        return {**staged_models(self.lake), **marts}


def claims_lake(spark: SparkSession, sf_dir: str) -> ClaimsLake:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        _LAKES[key] = ClaimsLake(spark, sf_dir)
    return _LAKES[key]
