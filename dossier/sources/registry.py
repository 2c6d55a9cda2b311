"""Plug-ins by source: what to do with the rows of each, told by name and not by import of a path."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The name under which a plug-in takes the rows of all sources that have none of their own.
GENERAL = "*"


@dataclass(frozen=True)
class Source:
    """A plug-in: ``parse`` makes records of the rows of its source. ``details`` False means that it has no detail pages to read."""

    key: str
    layer: int
    parse: Callable[[DataFrame], DataFrame]
    enabled: bool = True
    details: bool = True


@dataclass
class Registry:
    sources: dict[str, Source] = field(default_factory=dict)

    def add(self, source: Source) -> None:
        if source.key in self.sources:
            raise ValueError(f"source {source.key!r} is there already")
        self.sources[source.key] = source

    def of_layer(self, layer: int) -> list[Source]:
        """The enabled sources of a layer by name."""
        return [s for k, s in sorted(self.sources.items()) if s.enabled and s.layer == layer]

    def with_details(self) -> list[Source]:
        return [s for _, s in sorted(self.sources.items()) if s.enabled and s.details]

    def run(self, rows: DataFrame, column: str) -> DataFrame:
        """The rows of every enabled source through its plug-in, with its ``layer``; rows of sources without one go to the general plug-in, if
        there is one. Each plug-in is a part of one plan, not a loop over rows."""
        named = [s.key for s in self.sources.values() if s.key != GENERAL]
        made = None
        for source in self.sources.values():
            if source.enabled:
                own = rows.where(~F.coalesce(F.col(column).isin(named), F.lit(False)) if source.key == GENERAL else F.col(column) == source.key) if named or source.key != GENERAL else rows
                part = source.parse(own).withColumn("layer", F.lit(source.layer))
                made = part if made is None else made.unionByName(part)
        if made is None:
            raise ValueError("no source is enabled")
        return made


def settings(tree: dict, path: str, default=None):
    """A value of a nested configuration by its dotted path, the default where any part of it is missing or null."""
    for part in path.split("."):
        tree = tree.get(part) if isinstance(tree, dict) else None
    return default if tree is None else tree
