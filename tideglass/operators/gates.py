"""Quality gates: what data must satisfy before a reader may see it. Each is one pass, or one shuffle by the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.operators import ranges
from tideglass.operators.analysis import uncovered
from tideglass.spec import DatasetSpec


class GateError(ValueError):
    """Data that a gate refused."""


def check_schema(df: DataFrame, spec: DatasetSpec, partitions: Sequence[str] = ("year", "entity_bucket", "_source_id", "_producer_run_id")) -> DataFrame:
    """df, if it has the declared columns in their types and no others."""
    declared = {f.name: f.dataType.simpleString() for f in spec.struct_type()}
    present = {c: t for c, t in df.dtypes if c not in partitions}
    optional = {"quality_flag", "source_element"} if spec.storage == "long" else set()
    problems = [f"missing {c}" for c in declared if c not in present and c not in optional]
    problems += [f"undeclared {c}" for c in present if c not in declared]
    problems += [f"{c} is {present[c]}, not {t}" for c, t in declared.items() if c in present and present[c] != t]
    if problems:
        raise GateError(f"{spec.dataset_id}: " + "; ".join(problems))
    return df


def row_rules(df: DataFrame, spec: DatasetSpec) -> dict[str, Column]:
    """Names of rules to conditions that a bad row meets."""
    rules = {"entity_missing": F.col("entity_id").isNull() | (F.trim("entity_id") == "")}
    for c in spec.time_columns:
        rules[f"{c}_missing"] = F.col(c).isNull()
    if spec.temporal == "interval":
        rules["interval_not_positive"] = F.col("time_end") <= F.col("time_start")
    if spec.storage == "long":
        rules["variable_undeclared"] = ~F.coalesce(F.col("variable").isin([*spec.variable_names]), F.lit(False))
        if "source_element" in df.columns:
            rules["source_element_missing"] = F.col("source_element").isNull()
    return rules


def rule_counts(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row: n_rows, and for each rule how many rows break it."""
    return df.agg(F.count("*").alias("n_rows"), *(F.count_if(cond).alias(name) for name, cond in row_rules(df, spec).items()))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n): keys that occur more than once; counts are summed before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_no_duplicates(df: DataFrame, spec: DatasetSpec) -> None:
    found = duplicate_keys(df, spec.key_columns).limit(3).collect()
    if found:
        raise GateError(f"{spec.dataset_id}: repeated keys, such as {[tuple(map(str, r[:-1])) for r in found]}")


def collisions(new: DataFrame, prior: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Keys of new rows that prior rows have; only prior partitions that new rows fall into are read."""
    parts = [c for c in ("year", "entity_bucket") if c in prior.columns and c in new.columns]
    keys = [*spec.key_columns]
    if parts:
        touched = new.select(*parts).distinct()  # years times buckets at most
        prior = prior.join(F.broadcast(touched), parts, "left_semi")
    return new.select(*keys, *parts).join(prior.select(*keys, *parts), keys + parts, "left_semi").select(*keys)


def check_no_collisions(new: DataFrame, prior: DataFrame, spec: DatasetSpec) -> None:
    found = collisions(new, prior, spec).limit(3).collect()
    if found:
        raise GateError(f"{spec.dataset_id}: keys published before, such as {[tuple(map(str, r)) for r in found]}")


def band_quantiles(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(variable, q, measured, n): each banded variable's exact quantile over non-null (where so declared non-zero) values."""
    banded = [v for v in spec.variables if v.band]
    if not banded:
        return df.sparkSession.createDataFrame([], "variable string, q double, measured double, n long")
    if spec.storage == "long":
        values = df.select("variable", "value").filter(F.col("variable").isin([v.name for v in banded]))
    else:
        values = df.select(F.inline(F.array(*(F.struct(F.lit(v.name).alias("variable"), F.col(v.name).alias("value")) for v in banded))))
    zero = [v.name for v in banded if v.band.ignore_zeros]
    kept = values.filter(F.col("value").isNotNull() & ~(F.col("variable").isin(zero) & (F.col("value") == 0)) if zero else F.col("value").isNotNull())
    return ranges.quantiles(kept, "variable", "value", {v.name: [v.band.quantile] for v in banded})


def check_plausible(df: DataFrame, spec: DatasetSpec) -> None:
    """Each banded variable's quantile must lie in its band; a variable without values isn't measured."""
    bands = {v.name: v.band for v in spec.variables if v.band}
    for r in band_quantiles(df, spec).collect():  # a row a variable
        band = bands[r["variable"]]
        if not band.least <= r["measured"] <= band.most:
            raise GateError(f"{spec.dataset_id}.{r['variable']}: quantile {band.quantile} is {r['measured']}, outside [{band.least}, {band.most}]; {band.evidence}")


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first condition that holds; null where none does."""
    return F.coalesce(*(F.when(F.coalesce(cond, F.lit(True)), F.lit(name)) for name, cond in rules))


def refuse(df: DataFrame, reason: str, show: str, what: str) -> None:
    """Ends the job with up to three examples if any row has a reason."""
    found = df.filter(F.col(reason).isNotNull()).select(reason, show).orderBy(reason, show).limit(3).collect()
    if found:
        raise GateError(f"{what}: {[tuple(map(str, r)) for r in found]}")


def accounting(physical: DataFrame, accepted: DataFrame, rejected: DataFrame, slots: int = 1) -> DataFrame:
    """One row: physical lines, records behind the accepted rows, rejections, recovered records, and whether they add up."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    counts = n(physical, "physical").crossJoin(n(accepted, "accepted_rows")).crossJoin(rejected.agg(F.count("*").alias("rejected"), F.coalesce(F.sum("recovered_count"), F.lit(0)).alias("recovered")))
    records = F.expr(f"accepted_rows div {slots}")
    lines = records - F.col("recovered") + F.col("rejected")
    return counts.select("physical", records.alias("records"), "rejected", "recovered", ((F.col("physical") == lines) & (F.col("accepted_rows") % slots == 0)).alias("balanced"))


def refuse_shrinking(prior: DataFrame, new: DataFrame, mode: str = "checked") -> DataFrame:
    """(entity_id, start, end) ranges that `prior` covers and `new` doesn't; under 'checked' one of them ends the job.

    Modes 'allowed', 'rebuild' and 'replay' let a replacement cover less.
    """
    if mode not in ("checked", "allowed", "rebuild", "replay"):
        raise GateError(f"unknown mode {mode!r}")
    lost = uncovered(prior, new, "entity_id")
    if mode == "checked" and (bad := lost.limit(3).collect()):
        raise GateError(f"the replacement leaves out {[tuple(map(str, r)) for r in bad]}")
    return lost
