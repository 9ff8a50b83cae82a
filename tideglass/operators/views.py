"""The logical view of a dataset: keys, then one column a variable, from long or wide rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.scalars import entity_bucket, request_bound
from tideglass.spec import DatasetSpec, DeclarationError

LINEAGE = ("_source_id", "_producer_run_id")


def normalized_variables(spec: DatasetSpec, variable: str | Sequence[str] | None) -> list[str]:
    """The selected variables, all by default; an empty, unknown or repeated selection is refused."""
    if variable is None:
        return [*spec.variable_names]
    chosen = [variable] if isinstance(variable, str) else [*variable]
    if not chosen or len(set(chosen)) != len(chosen) or (unknown := set(chosen) - set(spec.variable_names)):
        raise DeclarationError(f"{spec.dataset_id}: select known variables once each, of {', '.join(spec.variable_names)}" + (f"; unknown: {', '.join(sorted(unknown))}" if chosen and len(set(chosen)) == len(chosen) else ""))
    return chosen


#: Ids up to which a request is a list of literals; more of them are joined.
MANY_IDS = 100


def normalized_entities(entity: str | Sequence[str] | DataFrame | None) -> list[str] | DataFrame:
    """The wanted entity ids; none, and an empty list, mean all. A table gives its column entity_id; an empty one means none."""
    if isinstance(entity, DataFrame):
        if dict(entity.dtypes).get("entity_id") != "string":
            raise DeclarationError("a table of entities has a text column entity_id")
        return entity.select("entity_id").distinct()
    chosen = [] if entity is None else [entity] if isinstance(entity, str) else [*entity]
    if any(not isinstance(e, str) for e in chosen):
        raise DeclarationError("entity ids are text")
    return chosen


def distinct_text(column: str) -> Column:
    """The distinct values of a group in order, joined by commas."""
    return F.array_join(F.sort_array(F.collect_set(column)), ",")


def guarded_pivot(long: DataFrame, spec: DatasetSpec, variables: Sequence[str], with_lineage: bool = False) -> DataFrame:
    """One row a key with the chosen variables, each with its quality column where it has one.

    A key that holds a variable twice ends the job. Keys without any chosen variable give nulls. One aggregation over
    the key's own columns; the conditions on entity and time that a reader adds reach the scan below it.
    """
    keys = ["entity_id", *spec.time_columns]
    aggregates = []
    for name in variables:
        own = F.col("variable") == name
        fault = F.raise_error(F.lit(f"{spec.dataset_id}: {name} occurs twice for one key"))
        once = F.count_if(own) > 1
        kind = spec.variable(name).spark_type
        aggregates.append(F.when(once, fault.cast(kind)).otherwise(F.max(F.when(own, F.col("value")))).cast(kind).alias(name))
        if flag := spec.variable(name).quality_field:
            aggregates.append(F.when(once, fault.cast("string")).otherwise(F.max(F.when(own, F.col("quality_flag")))).alias(flag))
    if with_lineage:
        aggregates += [distinct_text(c).alias(c) for c in LINEAGE]
    return long.groupBy(*keys).agg(*aggregates)


def logical_view(stored: DataFrame, spec: DatasetSpec, variables: Sequence[str], with_lineage: bool = False) -> DataFrame:
    """Keys, variables with their quality columns, annotations, and lineage if asked for."""
    if spec.storage == "long":
        return guarded_pivot(stored, spec, variables, with_lineage)
    columns: list[str] = ["entity_id", *spec.time_columns]
    for name in variables:
        columns += [name, *([spec.variable(name).quality_field] if spec.variable(name).quality_field else [])]
    return stored.select(*columns, *(a.name for a in spec.annotations), *(LINEAGE if with_lineage else ()))


def request_filter(df: DataFrame, spec: DatasetSpec, entities: Sequence[str] | DataFrame, start, end, partitioned: bool = False) -> DataFrame:
    """Rows of the wanted entities whose time_start lies in [start, end).

    On a table partitioned by year and entity_bucket the same request also goes against those columns, so that files
    outside it are not listed; the engine doesn't derive them from the keys. More than MANY_IDS entities are joined by
    bucket and id, not listed in the plan; with few of them the join is one of small tables, which Spark decides itself.
    """
    first, last = request_bound(start), request_bound(end)
    if first is not None and last is not None and last <= first:
        raise DeclarationError("end lies behind start")
    if (first or last) and not spec.time_columns:
        raise DeclarationError(f"{spec.dataset_id} has no times")
    stamp = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp")
    buckets = partitioned and spec.storage != "reference"
    if isinstance(entities, DataFrame) or len(entities) > MANY_IDS:
        ids = entities if isinstance(entities, DataFrame) else df.sparkSession.createDataFrame([(e,) for e in dict.fromkeys(entities)], "entity_id string")
        keys = ["entity_bucket", "entity_id"] if buckets else ["entity_id"]
        df = df.filter(F.col("entity_bucket").isin(bucket_numbers(entities, spec.buckets))) if buckets else df
        df = df.join(ids.withColumn("entity_bucket", entity_bucket(F.col("entity_id"), spec.buckets)) if buckets else ids, keys, "left_semi")
    elif entities:
        df = df.filter(F.col("entity_id").isin([*entities]))
        # the buckets of literals fold into literals
        df = df.filter(F.col("entity_bucket").isin(bucket_numbers(entities, spec.buckets))) if buckets else df
    if first is not None:
        df = df.filter(F.col("time_start") >= stamp(first))
        df = df.filter(F.col("year") >= first.year) if partitioned else df
    if last is not None:
        df = df.filter(F.col("time_start") < stamp(last))
        df = df.filter(F.col("year") <= last.year) if partitioned else df
    return df


def bucket_numbers(entities: Sequence[str] | DataFrame, buckets: int) -> list[int]:
    """entity_bucket of known ids, on the driver; of a table at most as many numbers as there are buckets come there."""
    import hashlib

    if isinstance(entities, DataFrame):
        return sorted(r[0] for r in entities.select(entity_bucket(F.col("entity_id"), buckets)).distinct().collect() if r[0] is not None)
    return sorted({int(hashlib.md5(e.encode()).hexdigest()[:15], 16) % buckets for e in entities})


def typed_output(view: DataFrame, spec: DatasetSpec, snapshot: str) -> DataFrame:
    """A logical view in output types (ids, qualities and annotations text, numbers double) with unit, dataset and snapshot as column metadata."""
    kinds = {f.name: f.dataType for f in view.schema}
    units = {v.name: v.unit for v in spec.variables}
    text = {"entity_id", *(v.quality_field for v in spec.variables if v.quality_field)}
    out = []
    for c in view.columns:
        number = c in units and kinds[c].simpleString() in ("tinyint", "smallint", "int", "bigint", "float") or kinds[c].simpleString().startswith("decimal")
        cast = F.col(c).cast("double") if number else F.col(c).cast("string") if c in text else F.col(c)
        out.append(cast.alias(c, metadata={"dataset_id": spec.dataset_id, "snapshot_id": snapshot} | ({"unit": units[c]} if c in units else {})))
    return view.select(*out)


def ordered(df: DataFrame, spec: DatasetSpec, limit: int | None = None) -> DataFrame:
    """By entity and times, so that a limit cuts at a defined place."""
    if limit is not None and limit < 1:
        raise DeclarationError("a limit is at least 1")
    out = df.orderBy("entity_id", *spec.time_columns)
    return out if limit is None else out.limit(limit)


def with_partitions(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """df with the columns that its files are partitioned by."""
    if spec.storage == "reference":
        return df
    return df.withColumn("year", F.year("time_start")).withColumn("entity_bucket", entity_bucket(F.col("entity_id"), spec.buckets))
