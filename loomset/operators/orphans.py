"""References to records that do not exist, kept up to date as references, parents and deletions arrive.

The state is two logs in a folder all executors share, each step's changes in a folder of their own: references whose answer changed, and what
arrived of parents. A step reads of them only the buckets of keys that its changes touch, and appends; now and then the logs are written
anew. A step counts once its marker is written, so that one that is run again, after a failure or a restart, does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import folder, hadoop, written

KEY = ["package", "name"]
REFERENCE = ["source_table", "ref_id", "package", "name", "ref_at"]
_REFERENCES = "source_table string, ref_id bigint, package string, name string, ref_at timestamp, reason string, step bigint, bucket int"
_PARENTS = "package string, name string, created_at timestamp, deleted_at timestamp, bucket int"
#: Parts of the key space. Rows of a step are sorted by them, so that a scan passes over row groups without the touched ones.
BUCKETS = 4096
#: Touched buckets up to which the logs are filtered by them.
MOST_TOUCHED = 1024


class Orphans:
    """Keyed state of pending references and of the parents that answer them.

    ``advance`` takes what arrived since the last time. New references probe the parent index; arriving parents probe the pending references to
    their keys, and deletions also those that were answered, so that a parent resolves the orphans that wait for it and a deletion reopens
    those it answered. A hot key meets one index row, so its join is split by AQE.

    References (source_table, ref_id, package, name, ref_at): a null name, id or time makes none; of re-delivered ones the latest counts, which
    repeats the key. Parents (package, name, created_at, deleted_at): of several rows of a key the earliest creation and the latest deletion
    count; a null package or name matches nothing; a null created_at was always there. Names compare as written. Empty tables leave the state
    as it is. ``path`` is where the state lies; of a folder with a state in it, that state goes on.
    """

    def __init__(self, path: str | None = None, compact: int = 24) -> None:
        self.path, self.compact = path, compact
        self.steps: list[int] | None = None
        self.whole: int | None = None

    def _open(self, spark: SparkSession) -> list[int]:
        """The steps that count after the last one that the whole state was written at."""
        self.spark = spark
        self.path = self.path or folder(spark)
        if self.steps is None:
            fs, top = hadoop(spark, self.path)
            found = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
            done = {kind: sorted(int(n[6:]) for n in found if n.startswith(f"{kind}-") and self._marked(n)) for kind in ("steps", "whole")}
            self.whole = max(done["whole"], default=None)
            self.steps = [k for k in done["steps"] if self.whole is None or k > self.whole]
        return self.steps

    def _dir(self, step: str, *parts: str) -> str:
        return "/".join([self.path, step, *parts])

    def _marked(self, step: str) -> bool:
        fs, at = hadoop(self.spark, self._dir(step, "done"))
        return fs.exists(at)

    def _mark(self, step: str) -> None:
        fs, at = hadoop(self.spark, self._dir(step, "done"))
        fs.create(at, True).close()

    def _log(self, name: str, schema: str, buckets: list[int] | None = None, also: int | None = None) -> DataFrame:
        parts = [f"whole-{self.whole}"] * (self.whole is not None) + [f"steps-{k}" for k in [*self.steps, *([also] if also is not None else [])]]
        if not parts:
            return self.spark.createDataFrame([], schema)
        x = self.spark.read.schema(schema).parquet(*[self._dir(p, name) for p in parts])
        return x if buckets is None else x.where(F.col("bucket").isin(buckets))

    @staticmethod
    def _bucket() -> Column:
        return F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).cast("int").alias("bucket")

    def _write(self, df: DataFrame, step: str, name: str) -> None:
        df.sortWithinPartitions("bucket").write.mode("overwrite").parquet(self._dir(step, name))

    def advance(self, references: DataFrame, parents: DataFrame, number: int | None = None) -> Orphans:
        """Takes what arrived; ``number`` names the step, and one that is done already changes nothing."""
        done = self._open(references.sparkSession)
        last = max([*done, -1 if self.whole is None else self.whole])
        step = last + 1 if number is None else number
        if step in done or (self.whole is not None and step <= self.whole):
            return self
        at = f"steps-{step}"
        new = references.select(*REFERENCE).where("name is not null and ref_id is not null and ref_at is not null").dropDuplicates(["source_table", "ref_id"])
        new = written(new.select(*REFERENCE, self._bucket()))
        came = parents.select(*KEY, "created_at", "deleted_at").where("package is not null and name is not null")
        self._write(self._index(came).select(*KEY, "created_at", "deleted_at", self._bucket()), at, "parents")
        came = self.spark.read.schema(_PARENTS).parquet(self._dir(at, "parents"))
        touched = [r.bucket for r in new.select("bucket").unionByName(came.select("bucket")).distinct().collect()]  # at most BUCKETS
        buckets = touched if len(touched) <= MOST_TOUCHED else None
        probe = new.select(*REFERENCE, F.lit("new").alias("was"))
        if last >= 0:
            keys = came.select(*KEY, F.col("deleted_at").isNotNull().alias("gone"))
            known = self._latest(self._log("references", _REFERENCES, buckets).join(keys, KEY)).where("reason is not null or gone")
            known = known.join(new.select("source_table", "ref_id"), ["source_table", "ref_id"], "left_anti")
            probe = probe.unionByName(known.select(*REFERENCE, F.coalesce("reason", F.lit("answered")).alias("was")))
        index = self._index(self._log("parents", _PARENTS, buckets, step)).withColumn("there", F.lit(True))
        reason = F.when(F.col("there").isNull(), "missing").when(F.col("created_at") > F.col("ref_at"), "late").when(F.col("deleted_at") <= F.col("ref_at"), "deleted")
        x = probe.join(index, KEY, "left").withColumn("reason", reason).where(F.coalesce("reason", F.lit("answered")) != F.col("was"))
        self._write(x.select(*REFERENCE, "reason", F.lit(step).cast("bigint").alias("step"), self._bucket()), at, "references")
        self._mark(at)
        self.steps = [*done, step]
        if len(self.steps) > self.compact:
            self._compacted(step)
        return self

    def _compacted(self, step: int) -> None:
        """Writes the whole state as it is after ``step``; from then on the steps up to it are not read."""
        at = f"whole-{step}"
        self._write(self.refs.select(*REFERENCE, "reason", F.lit(step).cast("bigint").alias("step"), self._bucket()), at, "references")
        self._write(self.index.select(*KEY, "created_at", "deleted_at", self._bucket()), at, "parents")
        self._mark(at)
        self.whole, self.steps = step, []

    @staticmethod
    def _index(parents: DataFrame) -> DataFrame:
        # a null created_at is the earliest of all
        born = F.min(F.coalesce("created_at", F.timestamp_seconds(F.lit(-62135596800))))
        return parents.groupBy(*KEY).agg(born.alias("created_at"), F.max("deleted_at").alias("deleted_at"))

    @staticmethod
    def _latest(log: DataFrame) -> DataFrame:
        rest = [c for c in log.columns if c not in ("source_table", "ref_id", "step")]
        return log.groupBy("source_table", "ref_id").agg(F.max_by(F.struct(*rest), "step").alias("r")).select("source_table", "ref_id", "r.*")

    @property
    def refs(self) -> DataFrame:
        """All references with their reason, null where a parent answers."""
        return self._latest(self._log("references", _REFERENCES)).select(*REFERENCE, "reason")

    @property
    def index(self) -> DataFrame:
        """The parents by key."""
        return self._index(self._log("parents", _PARENTS))

    def orphans(self) -> DataFrame:
        """(source_table, ref_id, reason, period): references that had no parent when they were made; period is their UTC month."""
        return self.refs.where("reason is not null").select("source_table", "ref_id", "reason", F.date_format("ref_at", "yyyy-MM").alias("period"))

    def snapshot(self) -> DataFrame:
        """(source_table, period, reason, orphans): counts of the state as it stands."""
        return self.orphans().groupBy("source_table", "period", "reason").agg(F.count("*").alias("orphans"))

    def open_at(self, moment) -> DataFrame:
        """(source_table, open_orphans): references made by ``moment`` whose parent isn't there at it: not arrived, or deleted since."""
        at = F.lit(moment).cast("timestamp")
        x = self.refs.where(F.col("ref_at") <= at).join(self.index.where(F.col("created_at") <= at), KEY, "left")
        gone = F.col("created_at").isNull() | (F.col("deleted_at") <= at)
        return x.groupBy("source_table").agg(F.count_if(F.coalesce(gone, F.lit(False))).alias("open_orphans"))


def replayed(references: DataFrame, parents: DataFrame, steps: int = 3) -> Orphans:
    """The state after all rows, fed in ``steps`` increments of arrival (loaded_at); rows without that time come first."""
    seconds = lambda df: df.agg(F.min(F.unix_seconds("loaded_at")), F.max(F.unix_seconds("loaded_at"))).first()
    ends = [x for df in (references, parents) for x in seconds(df) if x is not None]
    lo, hi = min(ends, default=0), max(ends, default=0)
    state = Orphans()
    step = F.least(F.lit(steps - 1), F.floor((F.coalesce(F.unix_seconds("loaded_at"), F.lit(lo)) - lo) * steps / (hi - lo + 1)))
    for k in range(steps):
        state.advance(references.where(step == k), parents.where(step == k))
    return state


def all_references(class_ref: DataFrame, cross_package_ref: DataFrame) -> DataFrame:
    """The references of both tables in one form, external ones left out."""
    a = class_ref.where(~F.coalesce("is_external", F.lit(False))).select(F.lit("class_ref").alias("source_table"), "ref_id", "package", F.col("class_name").alias("name"), "ref_at", "loaded_at")
    b = cross_package_ref.select(F.lit("cross_package_ref").alias("source_table"), F.col("xref_id").alias("ref_id"), F.col("to_package").alias("package"), F.col("via_class").alias("name"), "ref_at", "loaded_at")
    return a.unionByName(b)
