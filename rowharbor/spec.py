"""Declarative description of a target table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, types as T

from rowharbor.functions.dates import REFERENCE_YEAR

#: The type words a table description may use.
TYPE_WORDS = ("int", "float", "date", "dict", "str", "bool")

#: Load categories, in load order.
CATEGORIES = ("masters", "core", "relationship", "transactional")

#: Spark type each type word is coerced to in flight.
FLIGHT_TYPES = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "date": T.DateType(),
    "dict": T.StringType(),
    "str": T.StringType(),
    "bool": T.StringType(),
}


class SpecError(ValueError):
    """A table description contradicts itself or the data it is applied to."""


@dataclass(frozen=True)
class ForeignKey:
    """``column`` must hold a value of ``parent.parent_column`` or be missing."""

    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """Everything a load needs to know about one target table."""

    name: str
    pk: Sequence[str]
    types: Mapping[str, str]
    category: str = ""
    renames: Mapping[str, str] = field(default_factory=dict)
    foreign_keys: Sequence[ForeignKey] = ()
    #: ``filter`` rejects orphans, ``skip`` rejects a batch with any; unless stated, master tables skip and others filter.
    fk_policy: str = ""
    not_null: Sequence[str] = ()
    uniques: Sequence[Sequence[str]] = ()
    lengths: Mapping[str, int] = field(default_factory=dict)
    enums: Mapping[str, Sequence[str]] = field(default_factory=dict)
    decimals: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)
    list_columns: Sequence[str] = ()
    factor_column: str | None = None
    generated_key: str | None = None
    transforms: Sequence[Callable[[DataFrame], DataFrame]] = ()
    evolve: bool = True
    keep_time: bool = False
    real_bools: bool = False
    #: Two-digit years land within fifty years of this one.
    reference_year: int = REFERENCE_YEAR

    def __post_init__(self) -> None:
        if not self.pk:
            raise SpecError(f"No primary key configured/found for table {self.name}")
        if self.category and self.category not in CATEGORIES:
            raise SpecError(f"{self.name}: unknown category {self.category!r}")
        if not self.fk_policy:
            object.__setattr__(self, "fk_policy", "skip" if self.category == "masters" else "filter")
        if self.fk_policy not in ("filter", "skip"):
            raise SpecError(f"{self.name}: unknown foreign key policy {self.fk_policy!r}")
        unknown = sorted(set(self.types.values()) - set(TYPE_WORDS))
        if unknown:
            raise SpecError(f"{self.name}: unknown types {unknown}")
        known = set(self.types)
        stated = {
            "pk": self.pk,
            "not_null": self.not_null,
            "uniques": [c for cols in self.uniques for c in cols],
            "lengths": self.lengths,
            "enums": self.enums,
            "decimals": self.decimals,
            "defaults": self.defaults,
            "list_columns": self.list_columns,
            "foreign_keys": [fk.column for fk in self.foreign_keys],
            "generated_key": [self.generated_key] if self.generated_key else [],
            "factor_column": [self.factor_column] if self.factor_column else [],
        }
        for part, columns in stated.items():
            stray = [c for c in columns if c not in known]
            if stray:
                raise SpecError(f"{self.name}: {part} names columns without a type: {stray}")
        if self.generated_key and self.generated_key not in self.pk:
            raise SpecError(f"{self.name}: generated key {self.generated_key} is not in the primary key")

    def flight_schema(self) -> T.StructType:
        """Schema of coerced rows, before decimals are applied."""
        return T.StructType([T.StructField(c, self._flight_type(w)) for c, w in self.types.items()])

    def storage_schema(self) -> T.StructType:
        """Schema of the stored table: declared decimals replace doubles."""
        return T.StructType(
            [
                T.StructField(c, T.DecimalType(*self.decimals[c]) if c in self.decimals else self._flight_type(w))
                for c, w in self.types.items()
            ]
        )

    def _flight_type(self, word: str) -> T.DataType:
        if word == "date" and self.keep_time:
            return T.TimestampNTZType()
        if word == "bool" and self.real_bools:
            return T.BooleanType()
        return FLIGHT_TYPES[word]
