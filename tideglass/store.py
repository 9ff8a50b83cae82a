"""Snapshots of datasets on plain Parquet.

Data is written below data/<dataset>/run=<run>; nobody reads it until rows of `snapshots` and `fragments` name it. Metadata tables
only grow: the state of a run or snapshot is the latest row of its log. One driver per store is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideglass.functions.scalars import manifest_row_id
from tideglass.operators.gates import check_no_collisions, check_no_duplicates, check_plausible, check_schema, rule_counts
from tideglass.operators.views import LINEAGE, logical_view, normalized_entities, normalized_variables, ordered, request_filter, typed_output, with_partitions
from tideglass.plans.result import REJECTION
from tideglass.session import kept, shared_path
from tideglass.spec import DatasetSpec, DeclarationError, Registry

#: Stored rows that a collecting read may cover unless it has a limit.
MAX_ROWS = 25_000_000

SCHEMAS = {
    "source_files": "source_id string, path string, sha256 string, size_bytes long, registered_at timestamp",
    "source_aliases": "alias_id string, source_id string, original_name string, source_uri string, publisher_vintage string, fetched_at timestamp, recorded_at timestamp",
    "runs": "run_id string, dataset_id string, source_id string, version string, dataset_digest string, producer_kind string, state string, error string, at timestamp",
    "run_inputs": "run_id string, input_key string, source_id string, input_role string, details_json string",
    "rejections": f"run_id string, dataset_id string, source string, {REJECTION}",
    "snapshots": "snapshot_id string, dataset_id string, run_id string, mode string, parent_snapshot_id string, state string, reason string, at timestamp",
    "fragments": "fragment_id string, snapshot_id string, dataset_id string, run_id string, relative_path string, year int, entity_bucket int, row_count long, min_time timestamp, max_time timestamp",
    "derivation_edges": "snapshot_id string, parent_snapshot_id string, kind string, query_json string, version string",
}


class StoreError(LookupError):
    """A store that has not what was asked for."""


@dataclass(frozen=True)
class LoadResult:
    """The rows of a request, and what they are: dataset, snapshot, units by variable, fragments that were read, limit."""

    rows: DataFrame
    dataset_id: str
    snapshot_id: str
    units: dict[str, str]
    fragments: DataFrame
    limit: int | None


class Store:
    def __init__(self, spark: SparkSession, root: str, registry: Registry):
        self.spark, self.root, self.registry = spark, root.rstrip("/"), registry

    # metadata

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def meta(self, table: str) -> DataFrame:
        path = f"{self.root}/meta/{table}"
        return self.spark.read.schema(SCHEMAS[table]).parquet(path) if self._exists(path) else self.spark.createDataFrame([], SCHEMAS[table])

    def _append(self, table: str, rows: DataFrame | Sequence[tuple]) -> None:
        df = rows if isinstance(rows, DataFrame) else self.spark.createDataFrame([*rows], SCHEMAS[table])
        df.select(*self.spark.createDataFrame([], SCHEMAS[table]).columns).write.mode("append").parquet(f"{self.root}/meta/{table}")

    def _log(self, table: str, key: str) -> DataFrame:
        """The latest row of each key."""
        last = Window.partitionBy(key).orderBy(F.col("at").desc())
        return self.meta(table).withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")

    def record_rejections(self, run: str, dataset_id: str, rejected: DataFrame) -> None:
        """Adds rejections of a run to those it has; of a source and key the latest stay.

        The table is partitioned by run, and only the run's own partition is written anew.
        """
        path = f"{self.root}/meta/rejections"
        columns = [f.name for f in self.spark.createDataFrame([], SCHEMAS["rejections"]).schema if f.name != "run_id"]
        key = ["source", "rejection_key"]
        new = rejected.withColumn("dataset_id", F.lit(dataset_id)).select(*columns).dropDuplicates(key)
        before = self.meta("rejections").filter(F.col("run_id") == run).select(*columns)
        # a run's first rejections replace none: nothing is read that the write then overwrites
        whole = new if before.isEmpty() else kept(new.unionByName(before.join(new, key, "left_anti")), "rejections")
        whole.withColumn("run_id", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)

    def runs(self) -> DataFrame:
        return self._log("runs", "run_id")

    def snapshots(self) -> DataFrame:
        return self._log("snapshots", "snapshot_id")

    def register_declarations(self) -> None:
        for name in ("datasets", "variables"):
            getattr(self.registry, name)(self.spark).write.mode("overwrite").parquet(f"{self.root}/meta/{name}")

    def retired(self) -> DataFrame:
        """Snapshots' dataset ids that the registry no longer declares."""
        declared = self.registry.datasets(self.spark).select("dataset_id")
        return self.snapshots().select("dataset_id").distinct().join(declared, "dataset_id", "left_anti")

    def register_sources(self, paths: str | Sequence[str], vintage: str | None = None, glob: str | None = None) -> DataFrame:
        """(source_id, path): files by content. Known bytes are not registered again, new names of them are."""
        reader = self.spark.read.format("binaryFile")
        files = (reader.option("pathGlobFilter", glob) if glob else reader).load(paths)
        now = F.lit(datetime.now(UTC).replace(tzinfo=None)).cast("timestamp")
        found = files.select(F.sha2("content", 256).alias("sha256"), "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("fetched_at"))
        found = found.withColumn("source_id", F.concat(F.lit("src_"), F.substring("sha256", 1, 24))).persist()
        try:
            new = found.groupBy("source_id", "sha256", "size_bytes").agg(F.min("path").alias("path")).join(self.meta("source_files"), "source_id", "left_anti")
            self._append("source_files", new.withColumn("registered_at", now))
            name = F.element_at(F.split("path", "/"), -1)
            alias = found.select("source_id", name.alias("original_name"), F.col("path").alias("source_uri"), F.lit(vintage).cast("string").alias("publisher_vintage"), "fetched_at", now.alias("recorded_at"))
            alias = alias.withColumn("alias_id", F.sha2(F.concat_ws("\u001f", "source_id", "original_name", "source_uri").cast("binary"), 256))
            self._append("source_aliases", alias.join(self.meta("source_aliases"), "alias_id", "left_anti"))
            return self.spark.createDataFrame(found.select("source_id", "path").collect(), "source_id string, path string")  # a row a file of one call
        finally:
            found.unpersist()

    # runs and snapshots

    def live_snapshot(self, dataset_id: str, snapshot: str | None = None) -> str:
        """The newest committed snapshot, or the given one in whatever committed or superseded state."""
        rows = self.snapshots().filter(F.col("dataset_id") == dataset_id)
        wanted = rows.filter(F.col("snapshot_id") == snapshot) if snapshot else rows.filter("state = 'committed'")
        first = self.meta("snapshots").filter("state = 'committed'").groupBy("snapshot_id").agg(F.min("at").alias("committed_at"))
        found = wanted.join(first, "snapshot_id").orderBy(F.col("committed_at").desc()).select("snapshot_id").first()
        if found is None:
            raise StoreError(f"{dataset_id}: no snapshot {snapshot or 'is committed'}")
        return found[0]

    def publish(self, df: DataFrame, dataset_id: str, source_id: str, version: str, rejected: DataFrame | None = None, kind: str = "ingestion", parents: Sequence[str] = (), query: str | None = None, inputs: DataFrame | None = None) -> str:
        """Gates df, writes it and makes it the dataset's newest snapshot; its id.

        An append snapshot takes over the fragments of the newest one, a replacing one starts anew. The same data from
        the same source under the same version and declaration is published once: its snapshot is returned. A failed run
        leaves no readable trace. inputs: (input_key, source_id, input_role, details_json) of what else the run has read.
        """
        spec = self.registry.get(dataset_id).require_ready()
        same = (F.col("dataset_id") == dataset_id) & (F.col("source_id") == source_id) & (F.col("version") == version) & (F.col("dataset_digest") == spec.digest())
        done = self.runs().filter(same & (F.col("state") == "committed")).join(self.meta("snapshots").select("run_id", "snapshot_id").distinct(), "run_id").select("snapshot_id").first()
        if done:
            return done[0]
        run, snapshot, now = f"run_{uuid.uuid4().hex}", f"snap_{uuid.uuid4().hex}", lambda: datetime.now(UTC).replace(tzinfo=None)
        log = lambda state, error=None: self._append("runs", [(run, dataset_id, source_id, version, spec.digest(), kind, state, error, now())])
        log("running")
        try:
            own = self._write(check_schema(df, spec), spec, run, source_id)
            broken = {k: v for k, v in rule_counts(own, spec).first().asDict().items() if k != "n_rows" and v}
            if broken:
                raise ValueError(f"{dataset_id}: rows break {broken}")
            check_no_duplicates(own, spec)
            parent = None
            if spec.mode == "append" and not self.snapshots().filter((F.col("dataset_id") == dataset_id) & (F.col("state") == "committed")).isEmpty():
                parent = self.live_snapshot(dataset_id)
                check_no_collisions(own, self.scan(dataset_id, parent), spec)
            check_plausible(own, spec)
            self._append("fragments", self._fragments(own, spec, run, snapshot, parent))
        except Exception as fault:
            log("failed", str(fault)[:2000])
            raise
        if rejected is not None:
            self.record_rejections(run, dataset_id, rejected)
        if inputs is not None:
            self._append("run_inputs", inputs.withColumn("run_id", F.lit(run)).dropDuplicates(["run_id", "input_key"]))
        edges = [(snapshot, parent, "append_base", None, version)] if parent else []
        edges += [(snapshot, p, "derivation", query, version) for p in parents]
        if edges:
            self._append("derivation_edges", edges)
        log("committed")
        self._append("snapshots", [(snapshot, dataset_id, run, spec.mode, parent, "committed", None, now())])
        return snapshot

    def _write(self, df: DataFrame, spec: DatasetSpec, run: str, source_id: str) -> DataFrame:
        base = f"{self.root}/data/{spec.dataset_id}"
        out = with_partitions(df, spec).withColumns({LINEAGE[0]: F.lit(source_id), LINEAGE[1]: F.lit(run)})
        parts = [] if spec.storage == "reference" else ["year", "entity_bucket"]
        # in the order that a partitioned write asks for, or it would sort all rows again and lose theirs
        placed = out.repartition(*parts).sortWithinPartitions(*parts, "entity_id", *spec.time_columns) if parts else out
        writer = placed.write.option("compression", "zstd")
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{base}/run={run}")
        return self.spark.read.option("basePath", base).parquet(f"{base}/run={run}")

    def _fragments(self, own: DataFrame, spec: DatasetSpec, run: str, snapshot: str, parent: str | None) -> DataFrame:
        none = F.lit(None).cast("timestamp")
        low, high = (F.min("time_start"), F.max(spec.time_columns[-1])) if spec.time_columns else (none, none)
        parts = ["year", "entity_bucket"] if spec.storage != "reference" else []
        stats = own.groupBy(*parts).agg(F.count("*").alias("row_count"), low.alias("min_time"), high.alias("max_time")).filter("row_count > 0")
        path = F.concat(F.lit(f"run={run}"), *(x for p in parts for x in (F.lit(f"/{p}="), F.col(p).cast("string"))))
        number = lambda p: F.col(p).cast("int") if p in parts else F.lit(None).cast("int")
        new = stats.select(path.alias("relative_path"), number("year").alias("year"), number("entity_bucket").alias("entity_bucket"), "row_count", "min_time", "max_time", F.lit(run).alias("run_id"))
        if new.isEmpty():
            raise ValueError(f"{spec.dataset_id}: nothing to publish")
        if parent:
            new = new.unionByName(self.meta("fragments").filter(F.col("snapshot_id") == parent).select(*new.columns))
        return new.select(manifest_row_id(F.lit(snapshot), F.col("relative_path")).alias("fragment_id"), F.lit(snapshot).alias("snapshot_id"), F.lit(spec.dataset_id).alias("dataset_id"), *new.columns)

    def supersede(self, dataset_id: str, reason: str) -> int:
        """Makes all committed snapshots of a dataset superseded; how many."""
        if not reason.strip():
            raise DeclarationError("superseding needs a reason")
        rows = self.snapshots().filter((F.col("dataset_id") == dataset_id) & (F.col("state") == "committed")).collect()  # a row a snapshot
        if rows:
            self._append("snapshots", [tuple((r.asDict() | {"state": "superseded", "reason": reason, "at": datetime.now(UTC).replace(tzinfo=None)}).values()) for r in rows])
        return len(rows)

    def materialize(self, dataset_id: str, parents: Sequence[str], query: dict, version: str, make: Callable[[SparkSession, list[DataFrame]], DataFrame]) -> str:
        """Publishes what `make` derives from committed parent snapshots."""
        known = {r["snapshot_id"]: r["dataset_id"] for r in self.snapshots().filter("state = 'committed'").filter(F.col("snapshot_id").isin([*parents])).collect()}
        if missing := [p for p in parents if p not in known]:
            raise StoreError(f"parents not committed: {', '.join(missing)}")
        text = json.dumps(query, sort_keys=True)
        made = make(self.spark, [self.load(known[p], snapshot=p) for p in parents])
        return self.publish(made, dataset_id, f"derived:{'+'.join(sorted(parents))}:{text}", version, None, "derivation", parents, text)

    # reading

    def manifest(self, dataset_id: str, snapshot: str, entities: Sequence[str] | DataFrame = (), start=None, end=None) -> DataFrame:
        """The fragments of a snapshot that may hold rows of a request; unknown bounds stay in."""
        from tideglass.functions.scalars import request_bound
        from tideglass.operators.views import bucket_numbers

        spec, found = self.registry.get(dataset_id), self.meta("fragments").filter(F.col("snapshot_id") == snapshot)
        if spec.storage != "reference" and (isinstance(entities, DataFrame) or entities):
            found = found.filter(F.col("entity_bucket").isin(bucket_numbers(entities, spec.buckets)))
        stamp = lambda t: F.lit(request_bound(t).isoformat(sep=" ")).cast("timestamp")
        if start is not None:
            # an instant may stand at the bound itself; an interval's end may not
            found = found.filter(F.col("max_time").isNull() | ((F.col("max_time") >= stamp(start)) if spec.temporal == "instant" else (F.col("max_time") > stamp(start))))
        if end is not None:
            found = found.filter(F.col("min_time").isNull() | (F.col("min_time") < stamp(end)))
        return found

    def scan(self, dataset_id: str, snapshot: str, fragments: DataFrame | None = None) -> DataFrame:
        """The stored rows of exactly a manifest's fragments, under the declared columns; those that a fragment lacks are null.

        The declaration is the schema, so no file's footer is read while the plan is built.
        """
        base, spec = f"{self.root}/data/{dataset_id}", self.registry.get(dataset_id)
        parts = [] if spec.storage == "reference" else [("year", "integer"), ("entity_bucket", "integer")]
        schema = spec.struct_type()
        for name in LINEAGE:
            schema = schema.add(name, "string")
        for name, kind in [("run", "string"), *parts]:
            schema = schema.add(name, kind)
        rows = (fragments if fragments is not None else self.manifest(dataset_id, snapshot)).select("relative_path").distinct().collect()  # a path a fragment
        if not rows:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", base).schema(schema).parquet(*(f"{base}/{r[0]}" for r in rows))

    def load(self, dataset_id: str, entity=None, variable=None, start=None, end=None, snapshot: str | None = None, include_provenance: bool = False, limit: int | None = None) -> DataFrame:
        """The logical rows of a request, lazily, in key order only if a limit is given.

        start is inclusive, end exclusive, both on time_start; no entities means all, and they may be a table with a
        column entity_id. A key of a long dataset that holds none of the chosen variables gives a row of nulls. Columns
        bear their unit, and all of them dataset and snapshot, as metadata.
        """
        return self.result(dataset_id, entity, variable, start, end, snapshot, include_provenance, limit).rows

    def result(self, dataset_id: str, entity=None, variable=None, start=None, end=None, snapshot: str | None = None, include_provenance: bool = False, limit: int | None = None) -> LoadResult:
        """load() with what was read for it; columns are text, numbers or instants as their declaration says."""
        spec = self.registry.get(dataset_id).require_ready()
        variables, entities = normalized_variables(spec, variable), normalized_entities(entity)
        at = self.live_snapshot(dataset_id, snapshot)
        fragments = self.manifest(dataset_id, at, entities, start, end)
        stored = request_filter(self.scan(dataset_id, at, fragments), spec, entities, start, end, spec.storage != "reference")
        view = typed_output(logical_view(stored, spec, variables, include_provenance), spec, at)
        return LoadResult(view if limit is None else ordered(view, spec, limit), dataset_id, at, {v: spec.variable(v).unit for v in variables}, fragments, limit)

    def collect(self, dataset_id: str, max_rows: int = MAX_ROWS, limit: int | None = None, **request):
        """load() as pandas; refused when its fragments hold more than max_rows rows and no limit is given."""
        spec = self.registry.get(dataset_id)
        at = self.live_snapshot(dataset_id, request.get("snapshot"))
        n = self.manifest(dataset_id, at, normalized_entities(request.get("entity")), request.get("start"), request.get("end")).agg(F.sum("row_count")).first()[0] or 0
        if limit is None and n > max_rows:
            raise StoreError(f"{dataset_id}: {n} stored rows exceed max_rows = {max_rows}; narrow the request or set a limit")
        return ordered(self.load(dataset_id, limit=limit, **request), spec).toPandas()

    def connect(self) -> list[str]:
        """Temporary views: one a dataset with a committed snapshot, with lineage, and one a metadata table; their names."""
        live = {r[0] for r in self.snapshots().filter("state = 'committed'").select("dataset_id").distinct().collect()}
        names = []
        for spec in self.registry:
            if spec.ready and spec.dataset_id in live:
                self.load(spec.dataset_id, include_provenance=True).createOrReplaceTempView(spec.dataset_id)
                names.append(spec.dataset_id)
        for table in SCHEMAS:
            self.meta(table).createOrReplaceTempView(table)
        return [*names, *SCHEMAS]

    def describe(self, dataset_id: str) -> DatasetSpec:
        return self.registry.get(dataset_id)

    # lineage and audits

    def lineage(self, snapshot: str) -> DataFrame:
        """(snapshot_id, depth): a snapshot and all its ancestors, each once at its least depth."""
        return closure(self.meta("derivation_edges"), self.spark.createDataFrame([(snapshot,)], "snapshot_id string"))

    def provenance(self, dataset_id: str, snapshot: str | None = None) -> DataFrame:
        """(run_id, source_id, role, sha256, size_bytes, original_name): what a snapshot rests on, ancestors included."""
        at = self.lineage(self.live_snapshot(dataset_id, snapshot)).select("snapshot_id")
        runs = self.meta("fragments").join(at, "snapshot_id", "left_semi").select("run_id").distinct().join(self.runs().select("run_id", "source_id"), "run_id")
        inputs = self.meta("run_inputs").join(runs.select("run_id"), "run_id", "left_semi").select("run_id", "source_id", F.col("input_role").alias("role"))
        own = runs.join(inputs.select("run_id", "source_id"), ["run_id", "source_id"], "left_anti").select("run_id", "source_id", F.lit("observation_source").alias("role"))
        names = preferred_names(self.meta("source_aliases"))
        found = inputs.unionByName(own).distinct().join(self.meta("source_files").select("source_id", "sha256", "size_bytes"), "source_id", "left").join(names, "source_id", "left")
        return found.select("run_id", "source_id", "role", "sha256", "size_bytes", "original_name").orderBy("run_id", "role", "source_id")

    def runs_behind(self, dataset_id: str, snapshot: str | None = None) -> DataFrame:
        """The runs that wrote a snapshot's fragments or its ancestors', with version and source name."""
        at = self.lineage(self.live_snapshot(dataset_id, snapshot)).select("snapshot_id")
        wrote = self.meta("fragments").join(at, "snapshot_id", "left_semi").groupBy("run_id").agg(F.count_distinct("relative_path").alias("n_fragments"))
        return wrote.join(self.runs(), "run_id").join(preferred_names(self.meta("source_aliases")), "source_id", "left").select("run_id", "dataset_id", "version", "n_fragments", "original_name")

    def latest_inputs(self, dataset_id: str, role: str) -> DataFrame:
        """(input_key, source_id, details_json): inputs of one role behind the live snapshot's own run."""
        run = self.snapshots().filter(F.col("snapshot_id") == self.live_snapshot(dataset_id)).select("run_id")
        return self.meta("run_inputs").filter(F.col("input_role") == role).join(run, "run_id", "left_semi").select("input_key", "source_id", "details_json")

    def published_sources(self) -> DataFrame:
        """(dataset_id, source_id) that a committed run was made of, as its source or one of its inputs."""
        runs = self.runs().filter("state = 'committed'")
        more = self.meta("run_inputs").select("run_id", "source_id").join(runs.select("run_id", "dataset_id"), "run_id").select("dataset_id", "source_id")
        return runs.select("dataset_id", "source_id").unionByName(more).distinct()

    def runs_in(self, *states: str) -> DataFrame:
        return self.runs().filter(F.col("state").isin([*states]))

    def fragment_inventory(self, dataset_id: str | None = None, states: Sequence[str] = ("committed",)) -> DataFrame:
        """One row a stored fragment, however many snapshots share it: the snapshots' number, first and last time of commit."""
        at = self.snapshots().filter(F.col("state").isin([*states])).select("snapshot_id", "at")
        rows = self.meta("fragments") if dataset_id is None else self.meta("fragments").filter(F.col("dataset_id") == dataset_id)
        keys = ["dataset_id", "relative_path", "year", "entity_bucket"]
        return rows.join(at, "snapshot_id").groupBy(*keys).agg(F.max("row_count").alias("row_count"), F.count_distinct("snapshot_id").alias("n_snapshots"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))

    def code_summary(self) -> DataFrame:
        """One row: committed runs, those without a version of their code, those of uncommitted code (a version ending in +dirty)."""
        return self.runs_in("committed").agg(F.count("*").alias("committed"), F.count_if(F.coalesce("version", F.lit("")) == "").alias("without_version"), F.count_if(F.col("version").endswith("+dirty")).alias("uncommitted_code"))

    def rejection_audit(self) -> DataFrame:
        """Rejections of committed runs with the name of their run's source."""
        runs = self.runs_in("committed").select("run_id", "source_id", "version")
        return self.meta("rejections").join(runs, "run_id").join(preferred_names(self.meta("source_aliases")), "source_id", "left").select("dataset_id", "run_id", "source_id", "original_name", "source", "record_locator", "reason", "raw_length", "recovered_count")

    def replay(self, dataset_id: str, job: Callable[[str, str], str]) -> DataFrame:
        """(source_id, original_name, snapshot_id, error): job(source_id, path) for each registered source, in order of names.

        A source that fails is reported and the next one goes on.
        """
        known = preferred_names(self.meta("source_aliases")).join(self.meta("source_files"), "source_id").join(self.published_sources().filter(F.col("dataset_id") == dataset_id), "source_id", "left_semi")
        done = []
        for r in known.orderBy("original_name", "source_id").select("source_id", "original_name", "path").collect():  # a row a file
            try:
                done.append((r["source_id"], r["original_name"], job(r["source_id"], r["path"]), None))
            except Exception as fault:  # noqa: BLE001 - reported
                done.append((r["source_id"], r["original_name"], None, str(fault)[:2000]))
        return self.spark.createDataFrame(done, "source_id string, original_name string, snapshot_id string, error string")

    def overview(self) -> DataFrame:
        """Per declared dataset: committed and superseded snapshots."""
        count = lambda s: F.count_distinct(F.when(F.col("state") == s, F.col("snapshot_id"))).alias(s)
        return self.registry.datasets(self.spark).select("dataset_id").join(self.snapshots(), "dataset_id", "left").groupBy("dataset_id").agg(count("committed"), count("superseded"))

    def audit(self) -> DataFrame:
        """Findings (severity, code, detail): fragments without files, files without fragments, datasets retired or empty."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{self.root}/data").select(F.regexp_extract("path", r"/data/([^/]+)/(run=.*)/[^/]+$", 1).alias("dataset_id"), F.regexp_extract("path", r"/data/([^/]+)/(run=.*)/[^/]+$", 2).alias("relative_path")).distinct()
        named = self.meta("fragments").select("dataset_id", "relative_path").distinct()
        say = lambda df, severity, code, detail: df.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), detail.alias("detail"))
        where = F.concat_ws("/", "dataset_id", "relative_path")
        out = say(named.join(files, ["dataset_id", "relative_path"], "left_anti"), "error", "missing_file", where)
        out = out.unionByName(say(files.join(named, ["dataset_id", "relative_path"], "left_anti"), "warning", "unreferenced_file", where))
        out = out.unionByName(say(self.retired(), "info", "retired_dataset", F.col("dataset_id")))
        return out.unionByName(say(self.overview().filter("committed = 0"), "info", "no_committed_snapshot", F.col("dataset_id")))


def closure(edges: DataFrame, roots: DataFrame, rounds: int = 1000) -> DataFrame:
    """(snapshot_id, depth): roots and what they reach from child to parent, each once at its least depth.

    Each round joins the newest level to the edges and keeps what no level has. Levels are partitions of one table in the
    shared folder, so rounds neither lengthen the plan nor pass through the driver.
    """
    spark = edges.sparkSession
    base = shared_path(spark, "closure")
    read = lambda path: spark.read.schema("snapshot_id string, depth int").option("basePath", base).parquet(path)
    steps = kept(edges.filter("parent_snapshot_id IS NOT NULL").select("snapshot_id", "parent_snapshot_id").distinct(), "edges")
    roots.select("snapshot_id").distinct().write.parquet(f"{base}/depth=0")
    for depth in range(1, rounds + 1):
        level = read(f"{base}/depth={depth - 1}").select("snapshot_id").join(steps, "snapshot_id").select(F.col("parent_snapshot_id").alias("snapshot_id")).distinct()
        level.join(read(base).select("snapshot_id"), "snapshot_id", "left_anti").write.parquet(f"{base}/depth={depth}")
        if read(f"{base}/depth={depth}").isEmpty():
            return read(base)
    raise RuntimeError("lineage does not end")


def preferred_names(aliases: DataFrame) -> DataFrame:
    """(source_id, original_name): a publisher's name before one that is a digest, then the earliest."""
    order = Window.partitionBy("source_id").orderBy(F.col("original_name").rlike(r"^[0-9a-f]{32,64}(\.\w+)?$"), "recorded_at", "original_name")
    return aliases.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("source_id", "original_name")
