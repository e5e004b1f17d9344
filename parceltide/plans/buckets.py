"""A stored table that is changed bucket by bucket.

Rows lie in a fixed number of buckets by a hash of their key. A change rewrites the buckets that it touches into
a new version's folder and then publishes the version by a manifest, which says for every bucket which version
holds it. A reader picks a manifest and reads the folders it names, so it sees the table before or after a change
and never a mix; a version without a manifest does not exist. Two writers cannot publish the same version. The
folders of a replaced bucket stay until ``vacuum``, for readers that have begun.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_MANIFEST = "bucket int, held bigint, buckets int, version bigint"


@dataclass(frozen=True)
class BucketTable:
    spark: SparkSession
    path: str
    key: str
    schema: T.StructType

    def _files(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        files, target = self._files(f"{self.path}/manifest")
        if not files.exists(target):
            return []
        names = [s.getPath() for s in files.listStatus(target)]
        done = [p.getName() for p in names if files.exists(self._files(f"{p}/_SUCCESS")[1])]
        return sorted(int(n.split("=")[1]) for n in done if n.startswith("version="))

    def manifest(self, version: int | None = None) -> dict[int, int]:
        """Bucket to the version that holds it; at most one row per bucket."""
        return {r["bucket"]: r["held"] for r in self._manifest_rows(version) if r["bucket"] >= 0}

    def _manifest_rows(self, version: int | None) -> list:
        version = self.versions()[-1] if version is None else version
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/version={version}").collect()

    def buckets(self) -> int:
        return self._manifest_rows(None)[0]["buckets"]

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def create(self, rows: DataFrame, buckets: int) -> None:
        self._publish(rows, 0, {}, buckets, None)

    def read(self, only: list[int] | None = None, version: int | None = None) -> DataFrame:
        """The table, or some of its buckets. No folder of another bucket is looked at."""
        held = self.manifest(version)
        folders = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(held.items())
                   if only is None or b in only]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(
            *folders).select(*self.schema.names)

    def merge(self, changes: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the buckets that the keys of ``changes`` lie in by ``change(old rows, changes)`` and return
        them. ``changes`` is read twice, so it should be a table."""
        version, buckets = self.versions()[-1], self.buckets()
        touched = sorted(r[0] for r in changes.select(self.bucket(buckets)).distinct().collect())
        if touched:
            rows = change(self.read(touched, version), changes)
            self._publish(rows, version + 1, self.manifest(version), buckets, touched)
        return touched

    def _publish(self, rows: DataFrame, version: int, before: dict[int, int], buckets: int,
                 touched: list[int] | None) -> None:
        data = f"{self.path}/data/version={version}"
        rows.select(*self.schema.names).withColumn("bucket", self.bucket(buckets)).hint("rebalance", "bucket") \
            .write.mode("overwrite").partitionBy("bucket").parquet(data)
        files, target = self._files(data)
        written = [int(s.getPath().getName().split("=")[1]) for s in files.listStatus(target) if s.isDirectory()]
        held = {b: v for b, v in before.items() if b not in (touched or [])} | dict.fromkeys(written, version)
        manifest = [(b, v, buckets) for b, v in sorted(held.items())] or [(-1, version, buckets)]
        self.spark.createDataFrame(manifest, "bucket int, held bigint, buckets int").coalesce(1) \
            .write.mode("errorifexists").parquet(f"{self.path}/manifest/version={version}")

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` versions and the bucket folders that only the others name."""
        versions = self.versions()
        for version in versions[:-keep]:
            files, target = self._files(f"{self.path}/manifest/version={version}")
            files.delete(target, True)
        needed = {(v, b) for kept in versions[-keep:] for b, v in self.manifest(kept).items()}
        files, target = self._files(f"{self.path}/data")
        for folder in files.listStatus(target):
            version = int(folder.getPath().getName().split("=")[1])
            if version > versions[-1]:
                continue  # a change under way
            for inner in files.listStatus(folder.getPath()):
                name = inner.getPath().getName()
                if name.startswith("bucket=") and (version, int(name.split("=")[1])) not in needed:
                    files.delete(inner.getPath(), True)
