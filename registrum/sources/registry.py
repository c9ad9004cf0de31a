"""The registry's tables as Parquet, with all changes of a load made visible at once."""

from __future__ import annotations

import json
import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.routing import COMPANIES, route_csv, route_pages, run_stats

ISSUES = "array<string>"
SCHEMAS = {
    "import_runs": "id long, source string, started_at timestamp, finished_at timestamp, stats string",
    "import_rows": f"run_id long, source_file string, source_row int, external_id string, raw string, status string, issues {ISSUES}",
    "companies": COMPANIES,
    "duplicate_candidates": "external_id string, duplicate_of string, match_reason string, confidence string, details struct<new_name: string, existing_name: string, name_key_match: boolean, phone: string, city: string, address: string>, found_at timestamp",
    "email_candidates": f"external_id string, email string, local_part string, domain string, source string, status string, stage_failed string, issues {ISSUES}, checked_at timestamp",
}
#: What reset() leaves as it is.
SURVIVORS = ("email_candidates",)


def upsert(old: DataFrame, new: DataFrame, key: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """old without the rows whose key new has, and new. keep: columns that a row already there keeps."""
    if keep:
        held = old.select(*[F.col(c).alias(f"k_{c}") for c in (*key, *keep)])
        new = new.join(held, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in key], "left")
        new = new.select(*[F.coalesce(f"k_{c}", c).alias(c) if c in keep else F.col(c) for c in old.columns])
    return old.join(new.select(*key).distinct(), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


class Conflict(RuntimeError):
    """Another load was first."""


class Registry:
    """Tables under root. A pointer names the version of each; commit() writes new versions and then gives the next pointer its number, so a load
    that fails midway changes nothing that readers see. The number must be free: of two loads that began with the same pointer the second raises
    Conflict and has to be run again on what the first has left. Steps of a load are kept under root while it runs."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, at: str):
        return self._jvm.org.apache.hadoop.fs.Path(at)

    def version(self) -> int:
        """The number of the newest pointer; 0 before the first."""
        at = self._path(f"{self.root}/pointers")
        if not self._fs.exists(at):
            return 0
        return max([int(m[1]) for f in self._fs.listStatus(at) if (m := re.fullmatch(r"v([0-9]+)\.json", f.getPath().getName()))], default=0)

    def _pointer(self, version: int | None = None) -> dict[str, str]:
        version = self.version() if version is None else version
        if not version:
            return {}
        stream = self._fs.open(self._path(f"{self.root}/pointers/v{version:08d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _point(self, to: dict[str, str], onto: int) -> None:
        """Writes the pointer whole under another name and links or renames it to the number after onto, which fails if that is taken."""
        last, part = self._path(f"{self.root}/pointers/v{onto + 1:08d}.json"), self._path(f"{self.root}/pointers/.part-{uuid.uuid4().hex}")
        out = self._fs.create(part, False)
        try:
            out.write(bytearray(json.dumps(to).encode()))
        finally:
            out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                os.link(part.toUri().getPath(), last.toUri().getPath())
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context.rename(self._fs.makeQualified(part), self._fs.makeQualified(last), options)
        except (FileExistsError, Py4JJavaError) as e:
            if not self._fs.exists(last):
                raise
            raise Conflict(f"another load has made version {onto + 1}") from e
        finally:
            self._fs.delete(part, False)

    def create(self) -> None:
        """Makes the tables that are not there yet, empty."""
        self.commit({t: self.spark.createDataFrame([], s) for t, s in SCHEMAS.items() if t not in self._pointer()})

    def reset(self) -> None:
        """Empties all tables but SURVIVORS. Refuses a root that is not local."""
        if self._fs.getUri().getScheme() != "file":
            raise PermissionError("only a local registry is reset")
        self.create()
        self.commit({t: self.spark.createDataFrame([], s) for t, s in SCHEMAS.items() if t not in SURVIVORS})

    def table(self, name: str, version: int | None = None) -> DataFrame:
        at = self._pointer(version).get(name)
        return self.spark.createDataFrame([], SCHEMAS[name]) if at is None else self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{at}")

    def commit(self, tables: dict[str, DataFrame], onto: int | None = None) -> None:
        """Replaces tables, all at once. onto: the version that they were made from, by default the newest."""
        if not tables:
            return
        onto = self.version() if onto is None else onto
        pointer = self._pointer(onto)
        with ThreadPoolExecutor(len(tables)) as pool:  # the tables do not hang on each other
            for name, df in tables.items():
                pointer[name] = f"{name}/{uuid.uuid4().hex}"
            list(pool.map(lambda x: x[1].write.parquet(f"{self.root}/{pointer[x[0]]}"), tables.items()))
        self._point(pointer, onto)

    def _step(self, df: DataFrame, folder: str) -> DataFrame:
        """The same rows, computed once and kept under root."""
        at = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def views(self) -> None:
        for name in SCHEMAS:
            self.table(name).createOrReplaceTempView(name)

    def _load(self, source: str, normalized, route, files: int) -> dict:
        """normalized: the rows of the load from a function that keeps steps; route: what becomes of them."""
        # The wall clock before and after, not the time of one query.
        began = datetime.now(timezone.utc)
        onto, steps = self.version(), f"{self.root}/steps-{uuid.uuid4().hex}"

        def keep(df: DataFrame) -> DataFrame:
            return self._step(df, steps)

        try:
            runs, companies = self.table("import_runs", onto), self.table("companies", onto)
            run_id = (runs.agg(F.max("id")).first()[0] or 0) + 1
            now = F.lit(began)
            routed = route(keep(normalized(keep)), companies, now, keep)
            rows = keep(routed.rows)
            candidates = keep(routed.duplicates) if routed.duplicates is not None else None
            stats = run_stats(rows, files, candidates.count() if candidates is not None else 0)
            logged = rows.select(F.lit(run_id).cast("long").alias("run_id"), "source_file", "source_row", "external_id", "raw", "status", "issues")
            new = {"companies": routed.companies, "import_rows": upsert(self.table("import_rows", onto), logged, ["source_file", "source_row"])}
            if candidates is not None:
                new["duplicate_candidates"] = upsert(self.table("duplicate_candidates", onto), candidates.withColumn("found_at", now), ["external_id", "duplicate_of", "match_reason"], ("found_at",))
            run = self.spark.createDataFrame([(run_id, source, began, datetime.now(timezone.utc), json.dumps(stats, ensure_ascii=False))], SCHEMAS["import_runs"])
            self.commit({**new, "import_runs": runs.unionByName(run)}, onto)
        finally:
            self._fs.delete(self._path(steps), True)
        return stats

    def load_pages(self, folder: str, source: str = "api_pages") -> dict:
        from ..operators.checks import first_seen
        from ..operators.normalize import normalize
        from .pages import page_files, page_items, read_pages

        pages = read_pages(self.spark, folder)

        def normalized(keep) -> DataFrame:
            items = keep(page_items(pages))
            seen = first_seen(items.select(F.trim(F.col("fields")["city"]).alias("city"), "source_file", "source_row").filter("city <> ''"), "city", "source_file", "source_row")
            return normalize(items, [r.city for r in sorted(seen.collect(), key=lambda r: r["first"])])

        return self._load(source, normalized, lambda rows, companies, now, _: route_pages(rows, companies, source, now), len(page_files(self.spark, folder)))

    def load_csv(self, path: str, source: str = "review_csv") -> dict:
        from ..operators.normalize import normalize
        from .csv import csv_rows, read_csv

        known = self.table("companies").select("city_key").filter("city_key is not null").distinct()
        cities = [r.city_key for r in known.orderBy("city_key").collect()]
        rows = csv_rows(read_csv(self.spark, path))
        return self._load(source, lambda _: normalize(rows, cities), lambda rows, companies, now, keep: route_csv(rows, companies, source, now, keep), 1)

    def replace_emails(self, judged: DataFrame) -> None:
        self.commit({"email_candidates": judged.withColumn("checked_at", F.current_timestamp())})
