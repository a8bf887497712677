"""The panel key and the windows that operators share, so that Spark sorts once for all of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Window, WindowSpec


@dataclass(frozen=True)
class PanelKeys:
    """Names of the date, entity and group columns."""

    date: str = "date"
    entity: str = "entity"
    group: str = "grp"

    @property
    def all(self) -> list[str]:
        return [self.date, self.entity, self.group]

    @property
    def cross(self) -> list[str]:
        """What one cross-section has in common."""
        return [self.date, self.group]

    def path(self, order: str | None = None) -> WindowSpec:
        """An entity's rows in time order."""
        return Window.partitionBy(self.entity, self.group).orderBy(order or self.date)

    def back(self, n: int, last: int = 0, order: str | None = None) -> WindowSpec:
        """The n-th row before the current one up to the last-th before it (0: the current row)."""
        return self.path(order).rowsBetween(-n, -last)

    def ahead(self, first: int, last: int, order: str | None = None) -> WindowSpec:
        return self.path(order).rowsBetween(first, last)


P = PanelKeys()
