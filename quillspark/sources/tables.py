"""Table schemas, capability probes and Parquet loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Schemas of the store's tables, declared rather than inferred.
SCHEMAS: dict[str, str] = {
    "memory_items": "id long, content string, source_type string, project string, created_at timestamp, updated_at timestamp, embedding array<float>, is_active boolean, archived boolean, superseded_by long, content_hash string, metadata string, recall_count int, last_recalled_at timestamp, recall_boost double",
    "memory_sessions": "id long, project string, summary string, started_at timestamp, ended_at timestamp, messages_count int, processed_at timestamp",
    "memory_recall_log": "memory_id long, cited boolean, created_at timestamp, score double, surface string",
    "memory_inbox": "id long, created_at timestamp, source_agent string, project_hint string, text string, status string, promoted_memory_id long, rejection_reason string, metadata string, claimed_at timestamp, attempts int",
    "memory_relationships": "source_id long, target_id long, relationship_type string, weight double, inferred_at timestamp, inferred_by string, valid_at timestamp, invalid_at timestamp",
    "memory_objectives": "id long, project string, rank int, content string, status string, ratified_by string, ratified_at timestamp, supersedes long",
    "insights": "signal_key string, insight string, confidence decimal(4,3), source_ids array<long>, projects array<string>, created_at timestamp",
    "doctrine_registry": "id long, centroid array<double>, member_ids array<long>, member_hashes array<string>, projects array<string>, occurrence_count int, status string, doctrine_text string, synthesized_at timestamp",
    "sweep_ledger": "memory_id long, status string, attempts int, yields int, swept_at timestamp",
    "objective_flags": "dedup_key string, kind string, project string, memory_id long, objective_id long, severity string, rationale string, created_at timestamp",
    "objective_scan": "memory_id long, scanned_at timestamp, status string, attempts int, flags_written int, objectives_hash string, error string",
    "objective_coverage": "run_id string, project string, window_start timestamp, window_end timestamp, objective_count long, writes long, linked_writes long, coverage_ratio double, linkage_source string, drift boolean, note string",
    "job_runs": "job string, run_id string, started_at timestamp, finished_at timestamp, status string, counters map<string,long>, error string",
}


def schema(name: str) -> T.StructType:
    return T._parse_datatype_string(SCHEMAS[name])


def align(df: DataFrame, name: str, *also: str) -> DataFrame:
    """The table's columns in order and type, and those named beside them; those that are missing are null (additive schema healing)."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(name)], *also)


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def save(df: DataFrame, base: str, name: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(f"{base}/{name}.parquet")


def capabilities(df: DataFrame, wanted: list[str]) -> dict[str, bool]:
    """Which of the optional columns there are."""
    return {c: c in df.columns for c in wanted}


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
