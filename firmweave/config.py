"""Settings of the three jobs, with their defaults."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any, Self


@dataclass(frozen=True)
class _Config:
    @classmethod
    def from_mapping(cls, values: Mapping[str, Any]) -> Self:
        """Build from a plain mapping, say parsed JSON; an unknown key is an error."""
        unknown = set(values) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**values)


@dataclass(frozen=True)
class EtlConfig(_Config):
    source1_uri: str = "source1_supply_chain.parquet"
    source2_uri: str = "source2_financial.parquet"
    source1_format: str = "auto"
    source2_format: str = "auto"
    multiline: bool = False
    json_layout: str = "auto"
    lists_as_text: bool = False
    output_uri: str = "processed/"
    output_format: str = "parquet"
    save_intermediate: bool = False
    drop_blank_keys: bool = False
    hot_rows: int | None = 1_000_000
    processed_date: str | None = None
    timestamp: str | None = None
    table_enabled: bool = False
    table_name: str = "corporate_db.corporate_registry"
    table_root: str = ""
    table_catalog: str = ""
    table_mode: str = "append"
    #: Hash buckets of the id in a folder table that an upsert creates.
    table_buckets: int = 64
    #: Names this run's rows; a run that is repeated under the same name adds them to a folder table once.
    batch: str = ""
    partition_key: str = ""


@dataclass(frozen=True)
class MlConfig(_Config):
    table_name: str = "corporate_db.corporate_registry"
    table_root: str = ""
    table_catalog: str = ""
    tracking_root: str = "runs/"
    experiment_name: str = "corporate_profit_prediction"
    model_name: str = "corporate_profit_predictor"
    profit_threshold: float = 100.0
    train_ratio: float = 0.8
    seed: int = 42
    stable_split: bool = True
    max_iter: int = 100
    reg_param: float = 0.01
    feature_columns: tuple[str, ...] = ("revenue", "num_suppliers", "profit_margin_normalized")
    metadata_uri: str = ""


@dataclass(frozen=True)
class GenerateConfig(_Config):
    num_rows: int = 100
    output_format: str = "parquet"
    output_uri: str = "data/"
    seed: int = 42
    match_rate: float = 0.8
    skip_source1: bool = False
    skip_source2: bool = False
