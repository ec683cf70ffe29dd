"""Dataset descriptor: which columns are features, label and row id."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DatasetSpec:
    """Names the columns of a labelled table.

    ``features`` are scored in this order (it fixes the floating-point sum
    order); ``ids`` identify a row (needed by the long scorer and for joining
    predictions back). Positions in the file do not matter once columns are
    named, so label-first and label-last layouts use the same descriptor.
    """

    name: str
    features: tuple[str, ...]
    label: str
    ids: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        object.__setattr__(self, "features", tuple(self.features))
        object.__setattr__(self, "ids", tuple(self.ids))
        if not self.features:
            raise ValueError(f"dataset {self.name!r} needs at least one feature")
        if self.label in self.features:
            raise ValueError(f"label {self.label!r} is also a feature")
        if len(set(self.features)) != len(self.features):
            raise ValueError(f"duplicate feature names in {self.name!r}")

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.ids, self.label, *self.features)

    def with_name(self, name: str) -> "DatasetSpec":
        return DatasetSpec(name, self.features, self.label, self.ids)
