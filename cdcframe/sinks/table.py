"""The target table: parquet files in hash buckets of the key, merged batch by batch.

Layout of a table folder:

    rows/<generation>/       the rows as of some commit, one file for each bucket
    changes/<generation>/    the changes of the commits since, in the same buckets, with the attempt that wrote them
    manifest/<commit>.json   the current generation, the attempts that count, and the batches done
    stage/<commit>/          the batch being merged

A merge writes its changes beside the rows and becomes visible when its manifest is put in place by one rename; no stored
row is read to be written again. A read brings rows and changes together. Both lie in buckets that Spark knows of (they are
read as bucketed tables of the session's catalog, registered for the moment), so neither side is shuffled, and the rows are
not sorted either. When the changes have reached a stated share of the rows, the merged rows are written as a new generation,
again without a shuffle. If a job dies before the rename, the table is as it was, and what it wrote counts for nothing.

A table has ONE writer at a time, and its file system renames atomically.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcframe.files import Files
from cdcframe.functions.columns import col, column_list
from cdcframe.operators.merge import LATE, affected_rows, fold, merge
from cdcframe.operators.render import Bookkeeping
from cdcframe.operators.shape import OPERATIONS

# Columns of the changes, beside those of the table, which cannot have columns of these names.
_ATTEMPT = "_cdc_attempt"
_COMMIT = "_cdc_commit"
#: The place of a change among those of its commit and key.
STEP = "_cdc_step"
_EXTRA = T.StructType().add(_ATTEMPT, T.StringType()).add(_COMMIT, T.LongType()).add(STEP, T.LongType())

#: The changes are brought into the rows when they are this share of them, or this many commits.
FOLD_SHARE, FOLD_COMMITS = 0.25, 32
#: A bucket that has grown beyond twice this is cut in two when that happens.
BUCKET_BYTES = 512 * 1024 * 1024


@dataclass(frozen=True)
class Commit:
    """What a merge did. A batch that had been merged before is `skipped`."""

    version: int
    changes: int = 0
    buckets: int = 0
    skipped: bool = False
    #: Rows affected, by operation and whether their key was there before.
    affected: dict[tuple[str, bool], int] = field(default_factory=dict)


class TargetTable:
    """A keyed table at `path`. Use `create` or `open`."""

    def __init__(self, spark: SparkSession, path: str, manifest: dict):
        self.spark = spark
        self.path = path.rstrip("/")
        self._files = Files(spark, self.path)
        self._load(manifest)

    def _load(self, manifest: dict) -> None:
        self._manifest = manifest
        self.keys: list[str] = manifest["keys"]
        self.prefix: str = manifest["prefix"]
        #: The number of buckets; None until the first rows come.
        self.buckets: int | None = manifest["buckets"]
        self.late: str = manifest["late"]
        self.schema = T.StructType.fromJson(manifest["schema"])

    @classmethod
    def exists(cls, spark: SparkSession, path: str) -> bool:
        return bool(_commits(Files(spark, path), path))

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        payload: T.StructType,
        keys: str | Iterable[str],
        buckets: int | None = None,
        prefix: str = "cdc",
        late: str = "take",
    ) -> TargetTable:
        """A new empty table for payload (and key) columns of the given types.

        `buckets`, a power of two, is how many there are at first; by itself the table takes as many as its first batch
        needs, and doubles them as it grows. For `late` see `merge`.
        """
        if buckets is not None and (buckets < 1 or buckets & (buckets - 1)):
            raise ValueError("the number of buckets must be a power of two")
        if late not in LATE:
            raise ValueError(f"late must be one of {', '.join(LATE)}")
        keys, schema = column_list(keys), Bookkeeping(prefix).schema(payload)
        for key in keys:
            if key not in schema.names:
                raise ValueError(f"key column not found: {key}")
        if set(_EXTRA.names) & set(schema.names):
            raise ValueError(f"{', '.join(_EXTRA.names)} are reserved")
        manifest = {
            "commit": 0,
            "keys": keys,
            "prefix": prefix,
            "buckets": buckets,
            "late": late,
            "schema": schema.jsonValue(),
            "generation": "0",
            "rows": None,
            "changes": [],
            "batches": {},
            "streams": {},
        }
        table = cls(spark, path, manifest)
        table._publish(manifest)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> TargetTable:
        """The table at `path` as of its last commit."""
        files = Files(spark, path)
        commits = _commits(files, path)
        if not commits:
            raise FileNotFoundError(f"no table at {path}")
        return cls(spark, path, json.loads(files.read_text(_manifest_path(path, commits[-1]))))

    @property
    def version(self) -> int:
        return self._manifest["commit"]

    def refresh(self) -> None:
        """Move to the last commit."""
        last = _commits(self._files, self.path)[-1]
        if last != self.version:
            self._load(json.loads(self._files.read_text(_manifest_path(self.path, last))))

    def _publish(self, manifest: dict) -> None:
        self._files.write_text(_manifest_path(self.path, manifest["commit"]), json.dumps(manifest))
        self._load(manifest)

    def _bucket(self) -> Column:
        """The bucket of a row. It is the hash that a shuffle by the same columns uses, so after such a shuffle into a
        power of two of partitions, no more than there are buckets, each bucket lies in one of them."""
        return F.pmod(F.hash(*[col(key) for key in self.keys]), F.lit(self.buckets))

    def _folder(self, kind: str, manifest: dict | None = None) -> str:
        return f"{self.path}/{kind}/{(manifest or self._manifest)['generation']}"

    def _bucketed(self, folder: str, schema: T.StructType, buckets: int, rows: DataFrame | None = None) -> DataFrame:
        """The rows of a folder as Spark reads bucketed tables, after those given have been added."""
        name = f"cdcframe_{uuid.uuid4().hex}"
        keys = ", ".join("`" + key.replace("`", "``") + "`" for key in self.keys)
        location = folder.replace("\\", "\\\\").replace("'", "\\'")
        self._files.make(folder)
        self.spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet OPTIONS (compression 'zstd') "
            f"CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        try:
            if rows is not None:
                rows.select(*[col(field.name) for field in schema]).write.insertInto(name)
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")  # the files stay: they are not the catalog's

    def _changes_schema(self) -> T.StructType:
        return T.StructType([*self.schema, *_EXTRA])

    def _live_changes(self, manifest: dict) -> DataFrame:
        changes = self._bucketed(self._folder("changes", manifest), self._changes_schema(), manifest["buckets"])
        return changes.filter(col(_ATTEMPT).isin([change["attempt"] for change in manifest["changes"]]))

    def _read(self, manifest: dict) -> DataFrame:
        rows = None
        if manifest["rows"] is not None:
            rows = self._bucketed(self._folder("rows", manifest), self.schema, manifest["buckets"])
        if not manifest["changes"]:
            return self.spark.createDataFrame([], self.schema) if rows is None else rows
        changes = self._live_changes(manifest)
        return fold(rows, changes, self.keys, [_COMMIT, STEP], self.schema, self.prefix, manifest["late"])

    def read(self) -> DataFrame:
        """The rows of the table, soft-deleted ones included."""
        return self._read(self._manifest)

    def is_done(self, batch_id: int | None, writer: str = "default") -> bool:
        """Whether a batch of this writer has been merged already."""
        return batch_id is not None and batch_id <= self._manifest["batches"].get(writer, -1)

    def stage_path(self) -> str:
        """Where the batch of the next commit is staged."""
        return f"{self.path}/stage/{self.version + 1}"

    def merge(
        self,
        changes: DataFrame,
        batch_id: int | None = None,
        writer: str = "default",
        steps: bool = False,
        state: dict | None = None,
    ) -> Commit:
        """Merge rendered changes, at most one per key, and commit.

        The changes are read more than once, so they should be staged files. With a batch id, a batch
        that is not newer than the last one of its writer is skipped. With `steps`, they are changes of several batches
        that go one after the other: a key has one for each value of the column `_cdc_step`, and what is affected is not
        counted. `state` is kept for the writer, see `state_of`.
        """
        self.refresh()
        if self.is_done(batch_id, writer):
            return Commit(self.version, skipped=True)
        commit, attempt = self.version + 1, uuid.uuid4().hex
        step = col(STEP) if steps else F.lit(0).cast("bigint")
        changes = changes.select(
            *[col(field.name).cast(field.dataType).alias(field.name) for field in self.schema],
            F.lit(attempt).alias(_ATTEMPT),
            F.lit(commit).cast("bigint").alias(_COMMIT),
            step.alias(STEP),
        )
        manifest = json.loads(json.dumps(self._manifest))
        manifest["commit"] = commit
        if manifest["buckets"] is None:
            manifest["buckets"] = self.buckets = bucket_count(changes)
        operation = col(Bookkeeping(self.prefix).operation)
        facts = changes.agg(
            F.count(F.lit(1)).alias("rows"),
            F.collect_set(self._bucket()).alias("buckets"),
            *[F.count_if(operation == name).alias(name) for name in OPERATIONS],
        ).first()
        touched, affected = sorted(facts["buckets"]), {}
        if touched:
            total = {name: facts[name] for name in OPERATIONS}
            parts = changes.repartition(min(manifest["buckets"], _power(len(touched))), *[col(key) for key in self.keys])
            alone = not manifest["changes"] and not steps
            if alone and manifest["rows"] is None:
                affected = {(name, False): count for name, count in total.items() if count}
                self._renew(manifest, attempt, parts)
            elif alone and facts["rows"] >= FOLD_SHARE * manifest["rows"]:
                # So many changes are brought into the rows at once, and counted on the way.
                rows = self._bucketed(self._folder("rows"), self.schema, self.buckets)
                moved, counts = changes.repartition(self.buckets, *[col(key) for key in self.keys]), Observation()
                self._renew(manifest, attempt, merge(rows, moved, self.keys, self.prefix, counts, self.late))
                affected = affected_rows(counts.get)
            else:
                affected = {} if steps else self._affected(changes, touched, total)
                self._bucketed(self._folder("changes"), self._changes_schema(), manifest["buckets"], parts)
                manifest["changes"].append({"attempt": attempt, "rows": facts["rows"]})
                self._fold(manifest, attempt)
        if batch_id is not None:
            manifest["batches"][writer] = batch_id
        if state is not None:
            manifest["streams"][writer] = state
        self._publish(manifest)
        return Commit(commit, facts["rows"], len(touched), affected=affected)

    def state_of(self, writer: str) -> dict:
        """What the last commit of a writer that gave a state has kept."""
        return self._manifest["streams"].get(writer, {})

    def _fold(self, manifest: dict, attempt: str) -> None:
        """Bring the changes into the rows if they have become many, in a new generation. The rows stay where they lie, so
        nothing is shuffled, unless the buckets have become too large."""
        rows, changes = manifest["rows"] or 0, sum(change["rows"] for change in manifest["changes"])
        if changes >= FOLD_SHARE * rows or len(manifest["changes"]) >= FOLD_COMMITS:
            self._renew(manifest, attempt, self._read(manifest))

    def _renew(self, manifest: dict, attempt: str, rows: DataFrame) -> None:
        """Make these rows, which lie in buckets, the next generation."""
        counts, buckets = Observation(), manifest["buckets"]
        size = self._files.size(self._folder("rows", manifest)) + self._files.size(self._folder("changes", manifest))
        while size > 2 * BUCKET_BYTES * buckets:
            buckets *= 2
        if buckets != manifest["buckets"]:
            rows = rows.repartition(buckets, *[col(key) for key in self.keys])
        rows = rows.select(*[col(name) for name in self.schema.names]).observe(counts, F.count(F.lit(1)).alias("rows"))
        manifest.update(generation=f"{manifest['commit']}-{attempt}", changes=[], buckets=buckets)
        self._bucketed(self._folder("rows", manifest), self.schema, buckets, rows)
        manifest["rows"] = counts.get["rows"]

    def _known_keys(self, touched: list[int]) -> DataFrame | None:
        """The keys stored in some buckets, those of changes more than once. Of a few buckets, only their files are read."""
        manifest, found = self._manifest, []
        whole = 2 * len(touched) >= self.buckets
        for kind, there in (("rows", manifest["rows"] is not None), ("changes", bool(manifest["changes"]))):
            schema = self.schema if kind == "rows" else self._changes_schema()
            if not there:
                continue
            folder = self._folder(kind)
            if whole:
                rows = self._bucketed(folder, schema, self.buckets)
            else:
                names = [name for name in self._files.names(folder) if _bucket_of(name) in set(touched)]
                if not names:
                    continue
                rows = self.spark.read.schema(schema).parquet(*[f"{folder}/{name}" for name in names])
            if kind == "changes":
                rows = rows.filter(col(_ATTEMPT).isin([change["attempt"] for change in manifest["changes"]]))
            found.append(rows.select(*[col(key) for key in self.keys]))
        return None if not found else found[0] if len(found) == 1 else found[0].union(found[1])

    def _affected(self, changes: DataFrame, touched: list[int], total: dict[str, int]) -> dict[tuple[str, bool], int]:
        """Rows affected by operation and whether the key was there before. Spark broadcasts the changes if they are few."""
        operation, known = col(Bookkeeping(self.prefix).operation).alias("_operation"), self._known_keys(touched)
        matched = {}
        if known is not None:
            met = known.join(changes.select(*[col(key) for key in self.keys], operation), self.keys).distinct()
            matched = {r["_operation"]: r["count"] for r in met.groupBy("_operation").count().collect()}
        counts = {f"{name}_true": matched.get(name, 0) for name in total}
        counts |= {f"{name}_false": count - matched.get(name, 0) for name, count in total.items()}
        return affected_rows(counts)

    def vacuum(self, keep: int = 2) -> None:
        """Delete the files that none of the last `keep` commits needs. Older readers lose theirs."""
        commits = _commits(self._files, self.path)
        kept = [json.loads(self._files.read_text(_manifest_path(self.path, c))) for c in commits[-max(keep, 1) :]]
        live = {manifest["generation"] for manifest in kept}
        for kind in ("rows", "changes"):
            for generation in self._files.names(f"{self.path}/{kind}"):
                if generation not in live and int(generation.split("-")[0]) <= commits[-1]:
                    self._files.delete(f"{self.path}/{kind}/{generation}")
        for old in commits[: -max(keep, 1)]:
            self._files.delete(_manifest_path(self.path, old))


def _power(n: int) -> int:
    """The smallest power of two that is not below n."""
    return 1 << (n - 1).bit_length()


def _bucket_of(name: str) -> int | None:
    """The bucket of a file, from its name as Spark gives it."""
    found = re.search(r"_(\d+)(?:\..*)?$", name)
    return int(found.group(1)) if found and ".parquet" in name else None


def bucket_count(rows: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The number of buckets, a power of two, for a table as large as `rows`, by Spark's own estimate of their bytes.

    For frames that come from files without a join, whose estimate follows the files. No fewer than 8.
    """
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(8, _power(max(1, size // bucket_bytes)))


def _manifest_path(path: str, commit: int) -> str:
    return f"{path.rstrip('/')}/manifest/{commit:020d}.json"


def _commits(files: Files, path: str) -> list[int]:
    names = files.names(f"{path.rstrip('/')}/manifest")
    return [int(name.removesuffix(".json")) for name in names if name.endswith(".json")]
