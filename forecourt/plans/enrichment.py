"""From an id list to the flat company table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from forecourt.operators.registry import registry_flatten, registry_lookup
from forecourt.session import require_utc
from forecourt.sources.sinks import write_run


def company_table(
    ids: DataFrame, registry: DataFrame, mode: str = "strict", counts: Observation | None = None
) -> DataFrame:
    require_utc(ids.sparkSession)
    return registry_flatten(registry_lookup(ids, registry), mode, counts)


def write_company_table(
    ids: DataFrame, registry: DataFrame, folder: str, run_id: str, mode: str = "strict", fmt: str = "parquet"
) -> str:
    return write_run(company_table(ids, registry, mode), folder, "company_table", run_id, fmt)
