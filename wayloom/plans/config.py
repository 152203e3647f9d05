"""Settings of a split."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SplitConfig:
    """What to split at, and how finely.

    split_at_connectors: cut at every connector, not only at the outermost two.
    lr_columns_to_include / lr_columns_to_exclude: narrow the columns whose linear
        references are cut at and rescoped; by default every column that holds any.
    point_precision: decimal digits of added points.
    lr_split_point_min_dist_meters: a reference this close to an existing point reuses it;
        the same distance is the least overlap for a scoped value to hold on a piece.
    reuse_existing_intermediate_outputs: read finished stages instead of computing them.
    """

    split_at_connectors: bool = True
    lr_columns_to_include: list[str] = field(default_factory=list)
    lr_columns_to_exclude: list[str] = field(default_factory=list)
    point_precision: int = 7
    lr_split_point_min_dist_meters: float = 0.01
    reuse_existing_intermediate_outputs: bool = True


DEFAULT_CONFIG = SplitConfig()
