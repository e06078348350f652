"""The stored data set: five external tables of one database."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.operators import curation
from cohort_engine.session import tune_session
from cohort_engine.sources.io import (
    SCHEME,
    compact_codec,
    drop_table,
    load,
    quoted,
    read_tables,
    register_external,
    save,
    text_literal,
    unparsed_values,
)
from cohort_engine.sources.layout import zorder_write
from cohort_engine.sources.schemas import ENTITIES


class _Entity:
    """``dataset.name`` reads a table, ``dataset.name = df`` overwrites it."""

    def __set_name__(self, owner, name):
        self.name = name

    def __get__(self, dataset, owner=None):
        return self if dataset is None else dataset.table(self.name)

    def __set__(self, dataset, df):
        dataset.save(df, self.name)


class CohortDataset:
    """Patients, organizations, providers, encounters and their wide join.

    spark  session with a catalog
    db     database that holds the tables
    root   folder for the files, on storage all executors reach
    fmt    table format
    pii    columns of patients to store as sha1 only
    """

    patients = _Entity()
    organizations = _Entity()
    providers = _Entity()
    encounters = _Entity()
    patient_encounters = _Entity()

    def __init__(
        self,
        spark: SparkSession,
        db: str,
        root: str,
        fmt: str = "parquet",
        pii: Iterable[str] = (),
    ):
        self.spark = spark
        self.db = db
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.pii = tuple(pii)

    def path(self, entity: str) -> str:
        return f"{self.root}/{entity}"

    def table(self, entity: str) -> DataFrame:
        return self.spark.table(f"{quoted(self.db)}.{quoted(entity)}")

    def save(
        self, df: DataFrame, entity: str, partition_by: Sequence[str] | None = None
    ) -> None:
        """Overwrite the external table of an entity, now."""
        df.write.saveAsTable(
            f"{quoted(self.db)}.{quoted(entity)}",
            format=self.fmt,
            mode="overwrite",
            partitionBy=list(partition_by or []) or None,
            path=self.path(entity),
        )
        if entity in self._locations():
            self._record({entity: self.path(entity)})

    def create_database(self, comment: str = "Curated records of events") -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {quoted(self.db)} COMMENT {text_literal(comment)}"
            f" LOCATION {text_literal(self.path('database'))}"
        )

    def drop_all_tables(self) -> None:
        """Drop the database with its tables. The files stay."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {quoted(self.db)} CASCADE")

    def drop(self, entity: str) -> None:
        drop_table(self.spark, self.db, entity)

    def register(self, entities: Iterable[str] = ENTITIES) -> None:
        """Create tables over files that a former ``refresh``, ``save`` or ``cluster`` has
        written; tables over older files are pointed to the newest ones."""
        self.create_database()
        moved = self._locations()
        for entity in entities:
            path = moved.get(entity, self.path(entity))
            if self._location(entity) not in (None, path):
                self.drop(entity)
            register_external(self.spark, self.db, entity, path, self.fmt)

    def _location(self, entity: str) -> str | None:
        """Folder of a table in the catalog, as ``path`` writes it; None without the table."""
        name = f"{quoted(self.db)}.{quoted(entity)}"
        if not self.spark.catalog.tableExists(name):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
        found = rows.first()["data_type"]
        same = re.sub(SCHEME, "", found) == re.sub(SCHEME, "", self._locations().get(entity, ""))
        return self._locations()[entity] if same else found

    def _locations(self) -> dict[str, str]:
        """Where the tables are now, for those that ``refresh`` or ``cluster`` has moved or
        ``save`` has brought back; a row was appended for each such change."""
        table = f"{self.root}/_locations"
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(table)
        if not folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder):
            return {}
        last = F.max_by("path", "moved_at").alias("path")
        rows = self.spark.read.parquet(table).groupBy("entity").agg(last).collect()
        return {r.entity: r.path for r in rows}

    def _record(self, paths: Mapping[str, str]) -> None:
        """Append where tables are now, as one file: readers see all of it or nothing."""
        rows = self.spark.createDataFrame(list(paths.items()), "entity string, path string")
        rows = rows.withColumn("moved_at", F.current_timestamp()).coalesce(1)
        rows.write.mode("append").parquet(f"{self.root}/_locations")

    def _publish(self, paths: Mapping[str, str]) -> None:
        """Point tables to files that are complete; only the catalog changes from here on.

        The record comes first, so that ``register`` can finish what was interrupted.
        """
        self._record(paths)
        for entity, path in paths.items():
            self.drop(entity)
            register_external(self.spark, self.db, entity, path, self.fmt)

    def purge_storage(self) -> None:
        """Delete everything below ``root``."""
        if not re.sub(SCHEME, "", self.root).strip("/"):
            raise ValueError(f"refusing to delete {self.root!r}")
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)

    def _delete_below_root(self, keep: set[str]) -> None:
        """Delete the entries of ``root`` but those in ``keep`` and the database's folder."""
        context = self.spark.sparkContext
        kept = {p.rsplit("/", 1)[1] for p in keep | {self.path("database")}}
        folder = context._jvm.org.apache.hadoop.fs.Path(self.root)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        for entry in files.listStatus(folder):
            if entry.getPath().getName() not in kept:
                files.delete(entry.getPath(), True)

    def refresh(
        self,
        path: str,
        types: Mapping[str, Mapping[str, str]] | None = None,
        infer_schema: bool = False,
        purge: bool = False,
        strict: bool = False,
    ) -> None:
        """Rebuild all tables from a folder of CSV files.

        The new tables are written to new folders. Only when all are complete the catalog
        is pointed to them, so that a refresh that fails leaves the tables as they were, and
        readers never see some new and some missing tables for as long as a write takes.
        Files of the former tables stay, as readers may use them; ``purge`` deletes
        everything below ``root`` but the new tables afterwards, and refuses if the CSV
        files are below it. ``strict`` raises if a value does not parse, before anything is
        changed.
        """
        tune_session(self.spark)
        if purge and _is_below(path, self.root):
            raise ValueError(f"refusing to delete {self.root!r}, which holds {path!r}")
        if strict and not infer_schema:
            lost = unparsed_values(self.spark, path, types).collect()
            if lost:
                raise ValueError(
                    "values that do not parse: "
                    + ", ".join(f"{r.table}.{r.column} {r['values']}" for r in lost)
                )
        raw = read_tables(self.spark, path, types, infer_schema)
        run = uuid.uuid4().hex
        staged: dict[str, str] = {}

        def stage(entity: str, df: DataFrame) -> DataFrame:
            staged[entity] = f"{self.path(entity)}-{run}"
            save(df, staged[entity], self.fmt, compression=compact_codec(self.fmt))
            return load(self.spark, staged[entity], self.fmt)

        encounters = stage("encounters", curation.curate_encounters(raw["encounters"]))
        stage("providers", curation.curate_providers(raw["providers"]))
        organizations = stage(
            "organizations", curation.curate_organizations(raw["organizations"])
        )
        patients = stage("patients", curation.curate_patients(raw["patients"], self.pii))
        # From the stored tables: their sizes are known, so dimensions can be
        # broadcast where they are small, and the CSV files are not parsed again.
        stage(
            "patient_encounters",
            curation.patient_encounters(encounters, patients, organizations),
        )
        self.create_database()
        self._publish(staged)
        if purge:
            self._delete_below_root(keep={*staged.values(), f"{self.root}/_locations"})

    def cluster(self, entity: str, columns: Sequence[str], files: int | None = None) -> None:
        """Store an entity clustered by several columns, so that filters on any of
        them skip files.

        A ``delta`` table is clustered by its own command, which needs that format's
        package; that branch is not covered by the tests."""
        if self.fmt == "delta":
            by = ", ".join(quoted(c) for c in columns)
            self.spark.sql(f"OPTIMIZE {quoted(self.db)}.{quoted(entity)} ZORDER BY ({by})")
            return
        # The table cannot be overwritten while it is read: write next to it, then
        # point the table there. The former files stay, as readers may use them.
        path = f"{self.path(entity)}-clustered-{uuid.uuid4().hex}"
        zorder_write(self.table(entity), columns, path, files, self.fmt)
        self._publish({entity: path})


def _is_below(path: str, root: str) -> bool:
    """Whether ``path`` is ``root`` or inside it."""
    path, root = (re.sub(SCHEME, "", p).rstrip("/") + "/" for p in (path, root))
    return path.startswith(root)
