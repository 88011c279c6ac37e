from strataflow.plans.datasets import Dataset, RefreshFailed, read_dataset, refresh, stale
from strataflow.plans.ingest import (
    Outcome, WatermarkStore, backfill, ingest_table, land, run_all,
)
from strataflow.plans.monitor import layer_stats, read_runs, record_runs
from strataflow.plans.pipeline import bronze_to_silver, run, silver_to_gold

__all__ = [
    "Dataset", "RefreshFailed", "read_dataset", "refresh", "stale",
    "Outcome", "WatermarkStore", "backfill", "ingest_table", "land", "run_all",
    "layer_stats", "read_runs", "record_runs", "bronze_to_silver", "run", "silver_to_gold",
]
