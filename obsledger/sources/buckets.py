"""Tables kept in buckets of files: a change rewrites the buckets it touches and shows by one commit."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from obsledger.session import shuffles_given_back, staged

BUCKET = "_bucket"
COMMIT = "version bigint, bucket int, folder string, n bigint, job string, columns string"
STEPS = 1 << 16  # values of a key's first four hexadecimal digits
WRITTEN_TOGETHER = 256  # buckets that one write counts


@dataclass(frozen=True)
class BucketTable:
    """A table below `path` in `buckets` buckets by its `key`, a text of lower-case hexadecimal digits.

    Keys are digests, so leading digits share rows out evenly, and buckets follow the order of
    keys: a page of keys lies in one bucket, or few. Within a bucket files are parted by the
    columns `parts` and sorted by key.

    `path/data` has a folder per write, `path/commits` a file per commit with the folder of every
    bucket that it replaces; a bucket's newest row counts. Folders are written first and a commit
    is one file, so what a killed run leaves behind is never read, and a reader sees all of a change
    or nothing. One writer at a time.
    """

    spark: SparkSession
    path: str
    key: str
    buckets: int = 64
    parts: Sequence[str] = field(default_factory=tuple)

    def bucket(self) -> Column:
        """The bucket of a row; 0 for keys that are no digests."""
        step = F.conv(F.substring(self.key, 1, 4), 16, 10).cast("bigint")
        return F.coalesce(F.floor(step * self.buckets / STEPS), F.lit(0)).cast("int")

    def bucket_of(self, key: str) -> int:
        """The bucket in which `key` would lie."""
        return int(key[:4].ljust(4, "0"), 16) * self.buckets // STEPS

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMIT)

    def live(self) -> dict[int, tuple[int, str, int, str]]:
        """Of each bucket the newest commit: version, folder, rows, columns. At most `buckets` entries."""
        newest = self.commits().groupBy("bucket").agg(F.max(F.struct("version", "folder", "n", "columns")).alias("c"))
        return {r["bucket"]: tuple(r["c"]) for r in newest.collect()}

    def exists(self) -> bool:
        return bool(self.live())

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of the given buckets, or of all. Columns of `parts` and the bucket prune folders."""
        live = self.live()
        if not live:
            raise ValueError(f"nothing was committed at {self.path}")
        wanted = sorted(live if buckets is None else set(buckets) & set(live))
        schema = StructType.fromJson(json.loads(next(iter(live.values()))[3]))
        paths = [f"{self.path}/data/version={live[b][1]}/{BUCKET}={b}" for b in wanted if live[b][2]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        typed = StructType(schema.fields).add("version", StringType()).add(BUCKET, IntegerType())
        return self.spark.read.schema(typed).option("basePath", f"{self.path}/data").parquet(*paths).select(schema.names)

    def replace(self, rows: DataFrame, buckets: Iterable[int], job: str | None = None) -> dict[int, int]:
        """Make `rows` the whole content of `buckets` (rows of other buckets are an error); rows per bucket.

        Counts are taken in the write itself.
        """
        wanted, version = sorted(set(buckets)), 1 + max((c[0] for c in self.live().values()), default=-1)
        commit, columns = [], json.dumps(rows.schema.jsonValue())
        placed = rows.withColumn(BUCKET, self.bucket())
        for start in range(0, len(wanted), WRITTEN_TOGETHER):
            part = wanted[start : start + WRITTEN_TOGETHER]
            folder, seen = f"v{uuid4().hex}", Observation()
            mine = placed if len(wanted) <= WRITTEN_TOGETHER else placed.where(F.col(BUCKET).isin(part))
            order = [BUCKET, *self.parts, self.key]
            counts = [F.count_if(F.col(BUCKET) == b).alias(f"n{b}") for b in part]
            sorted_rows = mine.repartition(BUCKET, *self.parts).sortWithinPartitions(*order).observe(seen, F.count(F.lit(1)).alias("n"), *counts)
            with shuffles_given_back(self.spark):
                sorted_rows.write.option("compression", "zstd").partitionBy(BUCKET, *self.parts).parquet(f"{self.path}/data/version={folder}")
            found = seen.get
            if found["n"] != sum(found[f"n{b}"] for b in part):
                raise ValueError("rows outside the buckets that are replaced")
            commit += [(version, b, folder, found[f"n{b}"], job, columns) for b in part]
        self._commit(commit)
        return {c[1]: c[3] for c in commit}

    def _commit(self, rows: list[tuple]) -> None:
        if rows:
            self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def create(self, rows: DataFrame, job: str | None = None) -> "BucketTable":
        """Replace all buckets by `rows`."""
        self.replace(rows, range(self.buckets), job)
        return self

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets in which rows lie; at most `buckets` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def merge(self, batch: DataFrame, changed: Callable[[DataFrame, DataFrame], DataFrame], combine: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Merge `batch` and give back the buckets that were rewritten.

        `changed(stored, batch)` picks the rows of the batch that alter something, and only their buckets
        are rewritten, as `combine(stored, changed)`; both see the stored rows of buckets the batch
        lies in. The rows picked are written once, so that the rewrite does not look for them again. A batch that is merged again changes nothing and rewrites nothing.
        """
        news = staged(changed(self.read(self.touched(batch)), batch), "changed")
        buckets = self.touched(news)
        if buckets:
            self.replace(combine(self.read(buckets), news.where(self.bucket().isin(buckets))), buckets)
        return buckets
