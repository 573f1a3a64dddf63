"""Date-partitioned datasets that change in one step: batches of files, and a manifest that says which count.

Files are never changed or moved. A write adds a batch folder, ``<root>/<name>/batch=<id>/event_date=<day>/``, which
nobody reads yet. ``publish`` then adds the next manifest, ``<root>/_releases/<version>.json``: for each dataset its
schema and the batch that holds each of its days. Creating that one file is the switch, for all datasets of
the root together; whatever fails before it leaves the last release as it was. Readers take the newest manifest and
read just the folders it names, so one that has started goes on with its release.

Of two writers that start from the same release the later one to publish is refused and has to start again. Where
renaming a file can replace another (some object stores), let only one writer publish at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sinks.files import Files

DAY = "event_date="
# Fixed value: the folder name of rows without a date.
UNDATED = "__HIVE_DEFAULT_PARTITION__"


class ReleaseConflict(RuntimeError):
    """Another writer has published meanwhile."""


@dataclass(frozen=True)
class Staged:
    """A batch that is written and not yet published, and the days that it replaces: all, its own, or a range.

    ``emptied`` are more days to replace, which the batch has no rows of. ``note`` goes into the manifest with the
    batch; without one, the note of the release before stays.
    """

    name: str
    batch: str
    schema: T.StructType
    days: tuple[str, ...]
    only_dates: bool = False
    start: date | None = None
    end: date | None = None
    emptied: tuple[str, ...] = ()
    note: dict | None = None

    def replaces(self, day: str) -> bool:
        if self.start or self.end:
            after = not self.start or day >= self.start.isoformat()
            return day != UNDATED and after and (not self.end or day <= self.end.isoformat())
        return not self.only_dates or day in self.days or day in self.emptied


@dataclass(frozen=True)
class Release:
    """``datasets``: name -> {"schema": its JSON value, "days": {day: batch}, "note": {...}}."""

    version: int
    datasets: dict[str, dict]

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(self.datasets[name]["schema"])

    def after(self, changes: Iterable[Staged]) -> Release:
        datasets = dict(self.datasets)
        for staged in changes:
            before = datasets.get(staged.name, {"days": {}, "note": {}})
            days = before["days"]
            days = {day: batch for day, batch in days.items() if not staged.replaces(day)}
            days |= dict.fromkeys(staged.days, staged.batch)
            datasets[staged.name] = {
                "schema": staged.schema.jsonValue(),
                "days": dict(sorted(days.items())),
                "note": before["note"] if staged.note is None else staged.note,
            }
        return Release(self.version + 1, datasets)


class Releases:
    """The released datasets under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/_releases/{version:012d}.json"

    def versions(self) -> list[int]:
        names = self.files.names(f"{self.root}/_releases")
        return [int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0] != "."]

    def release(self, version: int | None = None) -> Release:
        """The newest release, or an older one that is still kept; version 0 is the empty start."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return Release(0, {})
        return Release(version, json.loads(self.files.read_text(self._manifest(version))))

    def stage(
        self,
        frame: DataFrame,
        name: str,
        only_dates: bool = False,
        start: date | None = None,
        end: date | None = None,
        note: dict | None = None,
    ) -> Staged:
        """Write ``frame`` as a batch of dataset ``name``: to replace all of it, the dates in the frame, or a range.

        The rebalance hint lets Spark size the files: small dates are gathered into one task and a date
        that holds much of the data is spread over several. Rows outside of the range raise.
        """
        batch = f"b{uuid.uuid4().hex}"
        folder = f"{self.root}/{name}/batch={batch}"
        frame.hint("rebalance", F.col("event_date")).write.partitionBy("event_date").parquet(folder)
        days = tuple(day.removeprefix(DAY) for day in self.files.names(folder) if day.startswith(DAY))
        fields = [field for field in frame.schema.fields if field.name != "event_date"]
        schema = T.StructType([*fields, T.StructField("event_date", T.DateType())])
        staged = Staged(name, batch, schema, days, only_dates, start, end, note=note)
        outside = [day for day in days if not staged.replaces(day)]
        if outside:
            raise ValueError(f"{name}: rows of {', '.join(outside)} are outside of the range to replace")
        return staged

    def publish(self, changes: Iterable[Staged], since: Release | None = None) -> Release:
        """Make the staged batches count, all at once; ``since`` is the release that they were built on."""
        base = since or self.release()
        release = base.after(changes)
        try:
            self.files.write_text(self._manifest(release.version), json.dumps(release.datasets))
        except Exception as failure:
            if self.files.exists(self._manifest(release.version)):
                raise ReleaseConflict(f"{self.root}: version {release.version} exists already") from failure
            raise
        return release

    def folders(self, name: str, release: Release | None = None) -> dict[str, str]:
        """Day -> folder of a dataset."""
        days = (release or self.release()).datasets[name]["days"]
        return {day: f"{self.root}/{name}/batch={batch}/{DAY}{day}" for day, batch in days.items()}

    def read(
        self,
        name: str,
        start: date | None = None,
        end: date | None = None,
        release: Release | None = None,
        days: set[str] | None = None,
    ) -> DataFrame:
        """A dataset, its days from ``start`` to ``end``, or certain days; only folders of these are listed."""
        release = release or self.release()
        folders = [
            folder
            for day, folder in self.folders(name, release).items()
            if (days is None or day in days)
            and (
                day == UNDATED and not (start or end)
                or day != UNDATED and (not start or day >= start.isoformat()) and (not end or day <= end.isoformat())
            )
        ]
        schema = release.schema(name)
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*folders)
        return rows.select(*schema.names)

    def clean(self, keep: int = 2, older_than_hours: float = 24) -> list[str]:
        """Delete batches that none of the last ``keep`` releases names, and older manifests; what was deleted.

        Younger batches stay, as they may be of a write that is still going on.
        """
        versions = self.versions()
        kept = [self.release(version) for version in versions[-keep:]]
        live = {f"{name}/{batch}" for r in kept for name, d in r.datasets.items() for batch in d["days"].values()}
        names = {name for release in kept for name in release.datasets}
        gone = [self._manifest(version) for version in versions[:-keep]]
        for name in sorted(names):
            for folder in self.files.names(f"{self.root}/{name}"):
                path = f"{self.root}/{name}/{folder}"
                stale = f"{name}/{folder.removeprefix('batch=')}" not in live
                if folder.startswith("batch=") and stale and self.files.age_seconds(path) > older_than_hours * 3600:
                    gone.append(path)
        for path in gone:
            self.files.delete(path)
        return gone


def split_path(path: str) -> tuple[str, str]:
    """Root and name of a dataset's path."""
    root, _, name = path.rstrip("/").rpartition("/")
    return root, name


def published(
    frame: DataFrame,
    path: str,
    only_dates: bool = False,
    start: date | None = None,
    end: date | None = None,
    note: dict | None = None,
) -> Release:
    """Replace all of a dataset, the dates in the frame, or a range of dates, in one step."""
    root, name = split_path(path)
    releases = Releases(frame.sparkSession, root)
    since = releases.release()
    return releases.publish([releases.stage(frame, name, only_dates, start, end, note)], since)


def dataset(spark: SparkSession, path: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """A released dataset, or the plain Parquet folder that ``path`` is (which is read whole)."""
    root, name = split_path(path)
    releases = Releases(spark, root)
    release = releases.release()
    return releases.read(name, start, end, release) if name in release.datasets else spark.read.parquet(path)
