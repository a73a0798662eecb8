"""Transit feed lake on Spark: feeds are decoded, flattened, landed as Parquet and compacted by time bucket."""

from .plans.config import LakeConfig, load_config_from_toml
from .plans.lake import Lake, run_pipeline, run_pipeline_from_toml

__all__ = ["Lake", "LakeConfig", "load_config_from_toml", "run_pipeline", "run_pipeline_from_toml"]
