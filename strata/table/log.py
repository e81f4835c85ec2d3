"""Versions of a path-addressed table, as small JSON files.

Layout under the table path::

    commits/<20-digit version>.json
    data/<generation>/strata_commit=<token>/[p=v/...]/part-*.parquet   written once

A version names its schema, its partition columns and its ``parts``: written
directories of one generation, which is the folder a version is read from with
a filter on ``strata_commit``. ``dropped`` has the partition leaves of parts that
an update or delete replaced; ``stored_types`` the columns of parts that were
written in a type the table has since widened. Data directories are never
changed after they are written; whatever replaces all rows starts a generation.

A table has one writer at a time. A version file is created only if it does
not exist yet, so a second writer gets ``TableConflictError`` instead of
replacing a version; on stores without exclusive creation nothing guards
against two writers.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

from strata.table.fs import HadoopFS

COMMITS = "commits"
DATA = "data"
COMMIT_COLUMN = "strata_commit"


class TableConflictError(RuntimeError):
    """Another writer committed the version this writer was about to create."""


class CorruptCommitError(RuntimeError):
    """A commit file exists but cannot be parsed (e.g. a crashed writer)."""


@dataclass(frozen=True)
class Commit:
    version: int
    operation: str
    schema: StructType
    partition_by: list[str]
    parts: list[str]
    dropped: dict[str, list[str]] = field(default_factory=dict)
    """Keys of the leaves that no longer count, by part."""
    stored_types: dict[str, dict] = field(default_factory=dict)
    """Type (as JSON) of columns at the time of writing, where it was narrower, by part."""
    metrics: dict = field(default_factory=dict)
    timestamp_ms: int = 0

    def to_json(self) -> str:
        return json.dumps({**vars(self), "schema": json.loads(self.schema.json())}, sort_keys=True)

    @property
    def generation(self) -> str | None:
        """Folder that holds all parts; None without parts."""
        return self.parts[0].rsplit("/", 1)[0] if self.parts else None

    @staticmethod
    def from_json(text: str) -> Commit:
        raw = json.loads(text)
        return Commit(**{**raw, "schema": StructType.fromJson(raw["schema"])})


def commit_name(version: int) -> str:
    return f"{COMMITS}/{version:020d}.json"


def latest_version(fs: HadoopFS) -> int | None:
    stems = (name.removesuffix(".json") for name in fs.list_names(COMMITS) if name.endswith(".json"))
    return max((int(stem) for stem in stems if stem.isdigit()), default=None)


def read_commit(fs: HadoopFS, version: int) -> Commit:
    name = commit_name(version)
    try:
        return Commit.from_json(fs.read_text(name))
    except (ValueError, KeyError, TypeError) as exc:
        raise CorruptCommitError(f"commit {version} at {fs.root}/{name} is unreadable") from exc


def write_commit(fs: HadoopFS, commit: Commit) -> Commit:
    stamped = Commit(**{**vars(commit), "timestamp_ms": int(time.time() * 1000)})
    if not fs.create_exclusive(commit_name(commit.version), stamped.to_json()):
        raise TableConflictError(f"version {commit.version} of {fs.root} was committed by another writer")
    return stamped
