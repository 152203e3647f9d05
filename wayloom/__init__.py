"""Road-network splitting on Spark: lines with many junctions become simple pieces."""

from wayloom.plans.config import SplitConfig
from wayloom.plans.splitter import split_features, split_network
from wayloom.sources.feature_io import FeatureIO, Stage

__all__ = ["FeatureIO", "SplitConfig", "Stage", "split_features", "split_network"]
