"""Versioned groups of tables whose saves are all or nothing.

A save writes its tables to a folder of its own and then creates one manifest file,
which must not exist yet.  Readers list manifests only, so a save that was cut short is invisible,
and of two writers of one version the second fails without touching the first.

    base/data/<group>/<version>-<random>/<table>     Parquet
    base/manifests/<group>/<version>.json            commit, with the caller's figures
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.sources.store import path_exists, write_text

MANIFEST = (
    "group_name string, version string, path string, tables array<string>, created_at timestamp, body string, complete boolean"
)


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _plain(name: str) -> str:
    if not re.fullmatch(r"[\w.\-]+", name):
        raise ValueError(f"{name!r} is not a plain name: letters, digits, '_', '-' and '.' only")
    return name


class VersionedTables:
    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")

    def save(self, group: str, tables: Mapping[str, DataFrame], body=None, version: str | None = None) -> str:
        """Write all tables and commit them as one version; returns its name.

        ``body`` is kept with the version: a mapping, or a function of the paths of the written tables.
        Without a name the version is the time to the microsecond, and a second writer of the
        same microsecond takes the next one.
        """
        folder = f"{self.base}/data/{_plain(group)}/{_plain(version or 'v')}-{uuid.uuid4().hex}"
        for name, table in tables.items():
            table.write.parquet(f"{folder}/{name}")
        figures = body({n: f"{folder}/{n}" for n in tables}) if callable(body) else body or {}
        while True:
            name = version or now().strftime("v_%Y%m%d_%H%M%S_%f")
            text = {
                "group_name": group, "version": name, "path": folder, "tables": sorted(tables),
                "created_at": now().isoformat(), "body": json.dumps(figures, default=str), "complete": True,
            }
            manifest = f"{self.base}/manifests/{group}/{name}.json"
            try:
                write_text(self.spark, manifest, json.dumps(text), overwrite=False)
                return name
            except Py4JJavaError:
                if not path_exists(self.spark, manifest):
                    raise
                if version is not None:
                    raise FileExistsError(f"version {version} of {group} is there already") from None

    def versions(self, group: str | None = None) -> DataFrame:
        """Committed versions: a row each, with the caller's figures as JSON in ``body``."""
        where = f"{self.base}/manifests" + (f"/{_plain(group)}" if group else "")
        if not path_exists(self.spark, where):
            return self.spark.createDataFrame([], MANIFEST).drop("complete")
        lines = self.spark.read.option("recursiveFileLookup", "true").schema(MANIFEST).json(where)
        # A manifest that was cut short is no commit.
        return lines.where(F.coalesce("complete", F.lit(False))).drop("complete")

    def load(self, group: str, version: str | None = None) -> tuple[dict[str, DataFrame], dict, str]:
        """(tables, figures, version); the newest version is the greatest name."""
        found = self.versions(group)
        if version is not None:
            found = found.where(F.col("version") == version)
        rows = found.orderBy(F.desc("version"), F.desc("created_at")).limit(1).collect()
        if not rows:
            raise FileNotFoundError(f"no {group}/{version or 'latest'} under {self.base}")
        row = rows[0]
        tables = {n: self.spark.read.parquet(f"{row['path']}/{n}") for n in row["tables"]}
        return tables, json.loads(row["body"]), row["version"]
