"""Dataset declarations: what a dataset holds, in which units, keys and partitions, and which values count as missing.

A declaration is a driver-side value. Operators read it while they build a plan; nothing of it but literals reaches a task.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class DeclarationError(ValueError):
    """A declaration, or a request against one, that makes no sense."""


@dataclass(frozen=True)
class PlausibilityBand:
    """One quantile of a variable must lie within [least, most]."""

    quantile: float
    least: float
    most: float
    evidence: str
    ignore_zeros: bool = False

    def __post_init__(self):
        if not 0 <= self.quantile <= 1 or self.least > self.most or not self.evidence.strip():
            raise DeclarationError("a band needs a quantile within [0, 1], ordered limits and evidence")


@dataclass(frozen=True)
class VariableSpec:
    """One quantity in one unit."""

    name: str
    unit: str
    dtype: str = "float64"
    quantity: str = ""
    quality_field: str | None = None
    band: PlausibilityBand | None = None

    def __post_init__(self):
        if self.dtype not in ("float64", "string"):
            raise DeclarationError(f"{self.name}: values are float64 or string, not {self.dtype}")

    @property
    def spark_type(self) -> T.DataType:
        return T.DoubleType() if self.dtype == "float64" else T.StringType()


@dataclass(frozen=True)
class AnnotationSpec:
    """A source column kept beside the values that is no measurement."""

    name: str
    dtype: str = "string"

    @property
    def spark_type(self) -> T.DataType:
        return T.DoubleType() if self.dtype == "float64" else T.StringType()


@dataclass(frozen=True)
class SentinelRule:
    """A marker that stands for a missing value (null) or a measured zero within [start, end)."""

    marker: str
    meaning: str = "missing"
    start: datetime | None = None
    end: datetime | None = None

    def __post_init__(self):
        if self.meaning not in ("missing", "not_applicable", "measured_zero"):
            raise DeclarationError(f"unknown meaning {self.meaning!r}")

    @property
    def value(self) -> float | None:
        return 0.0 if self.meaning == "measured_zero" else None


@dataclass(frozen=True)
class DatasetSpec:
    """storage: long, wide or reference; temporal: interval, instant or none; mode: append or replace."""

    dataset_id: str
    storage: str = "long"
    temporal: str = "interval"
    mode: str = "append"
    timezone: str = "UTC"
    variables: tuple[VariableSpec, ...] = ()
    annotations: tuple[AnnotationSpec, ...] = ()
    sentinels: tuple[SentinelRule, ...] = ()
    buckets: int = 8
    ready: bool = True
    open_decisions: tuple[str, ...] = ()
    options: dict = field(default_factory=dict, hash=False)
    documentation: str = ""

    def __post_init__(self):
        if self.storage not in ("long", "wide", "reference") or self.temporal not in ("interval", "instant", "none") or self.mode not in ("append", "replace"):
            raise DeclarationError(f"{self.dataset_id}: unknown storage, temporal kind or mode")
        if self.ready and not self.variables:
            raise DeclarationError(f"{self.dataset_id}: a ready dataset declares its variables")
        names = [*self.variable_names, *(v.quality_field for v in self.variables if v.quality_field), *(a.name for a in self.annotations)]
        if self.storage != "long" and len(set(names)) != len(names):
            raise DeclarationError(f"{self.dataset_id}: a column is declared twice")

    @property
    def variable_names(self) -> tuple[str, ...]:
        return tuple(v.name for v in self.variables)

    @property
    def time_columns(self) -> tuple[str, ...]:
        return {"interval": ("time_start", "time_end"), "instant": ("time_start",), "none": ()}[self.temporal]

    @property
    def key_columns(self) -> tuple[str, ...]:
        return ("entity_id", *self.time_columns, *(("variable",) if self.storage == "long" else ()))

    def variable(self, name: str) -> VariableSpec:
        return next(v for v in self.variables if v.name == name)

    def require_ready(self) -> DatasetSpec:
        if not self.ready:
            raise DeclarationError(f"{self.dataset_id} is provisional; open: {', '.join(self.open_decisions) or 'its declaration'}")
        return self

    def struct_type(self) -> T.StructType:
        """The canonical columns; units and quantities are column metadata."""
        keys = [T.StructField("entity_id", T.StringType(), False), *(T.StructField(c, T.TimestampType(), False) for c in self.time_columns)]
        if self.storage == "long":
            rest = [T.StructField("variable", T.StringType(), False), T.StructField("value", T.DoubleType()), T.StructField("quality_flag", T.StringType()), T.StructField("source_element", T.StringType())]
            return T.StructType([*keys, *rest])
        out = [*keys]
        for v in self.variables:
            out.append(T.StructField(v.name, v.spark_type, True, {"unit": v.unit, "quantity": v.quantity or v.name, "quality_field": v.quality_field or ""}))
            if v.quality_field:
                out.append(T.StructField(v.quality_field, T.StringType()))
        return T.StructType([*out, *(T.StructField(a.name, a.spark_type) for a in self.annotations)])

    def digest(self) -> str:
        """Of all that decides the data: documentation and plausibility bands are left out."""
        bare = replace(self, documentation="", open_decisions=(), variables=tuple(replace(v, band=None) for v in self.variables))
        return hashlib.sha256(json.dumps(asdict(bare), sort_keys=True, default=str).encode()).hexdigest()


class Registry:
    """Dataset ids to declarations."""

    def __init__(self, specs: list[DatasetSpec] | tuple[DatasetSpec, ...] = ()):
        self._specs: dict[str, DatasetSpec] = {}
        for s in specs:
            if s.dataset_id in self._specs:
                raise DeclarationError(f"{s.dataset_id} is declared twice")
            self._specs[s.dataset_id] = s

    def get(self, dataset_id: str) -> DatasetSpec:
        if dataset_id not in self._specs:
            raise DeclarationError(f"unknown dataset {dataset_id!r}; known: {', '.join(sorted(self._specs))}")
        return self._specs[dataset_id]

    def __iter__(self):
        return iter(self._specs.values())

    def overlay(self, text: str, allowed: tuple[str, ...] = ("timezone", "ready", "open_decisions", "options", "documentation", "buckets", "sentinels", "mode")) -> Registry:
        """A registry with fields of known datasets refined by JSON: {dataset_id: {field: value}}."""
        changed = dict(self._specs)
        for dataset_id, fields in json.loads(text).items():
            spec = self.get(dataset_id)
            if unknown := set(fields) - set(allowed):
                raise DeclarationError(f"{dataset_id}: {', '.join(sorted(unknown))} may not be refined")
            fields = {k: tuple(SentinelRule(**r) for r in v) if k == "sentinels" else tuple(v) if isinstance(v, list) else v for k, v in fields.items()}
            changed[dataset_id] = replace(spec, **fields)
        return Registry([*changed.values()])

    def datasets(self, spark: SparkSession) -> DataFrame:
        """One row a dataset."""
        rows = [(s.dataset_id, s.storage, s.temporal, s.mode, s.timezone, s.ready, "; ".join(s.open_decisions), s.digest()) for s in self]
        return spark.createDataFrame(rows, "dataset_id string, storage string, temporal string, mode string, timezone string, ready boolean, open_decisions string, dataset_digest string")

    def variables(self, spark: SparkSession) -> DataFrame:
        """One row a variable."""
        rows = [(s.dataset_id, v.name, v.quantity or v.name, v.unit, v.dtype, v.quality_field) for s in self for v in s.variables]
        return spark.createDataFrame(rows, "dataset_id string, variable string, quantity string, unit string, dtype string, quality_field string")
