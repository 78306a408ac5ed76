"""A keyed result table as a log of changed rows in hash buckets.

Rows live in ``data/w=<write>/b=<bucket>``; a bucket is a base and the changes
written after it, the newest row of a key wins.  A commit writes the changed
rows only.  It rewrites a bucket when its changes outgrow a share of its base;
where the changes hold every row of a bucket they simply become its base.

``manifests/<version>.json`` names the folders of a version, and what readers
and the next writer would otherwise scan for: the newest batch of every
query (replay test), the history clears applied, the first write of every
model (write horizon) and the windows still open.  A version counts once its
manifest is there (written aside, then renamed); folders of a crashed commit
are replaced by the next one.  Readers take one manifest.  One writer at a time.
The root belongs in a shared file system.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from netbaseline.operators.open_windows import OpenWindows
from netbaseline.operators.profile import KEY_WITH_DIRECTION, RESULT_COLUMNS
from netbaseline.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, is_small
from netbaseline.schema import RESULT_SCHEMA

BUCKETS = 32
COMPACT_SHARE = 0.25      # changed rows of a bucket, as a share of its base, that lead to a rewrite
MAX_CHANGES = 32          # or that many folders of changes
MAX_DROPPED = 64          # tables of dropped records before they become one
DROPPED = ("reason", "window_start", "n")
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_STORED = StructType([*RESULT_SCHEMA.fields, StructField("w", LongType()), StructField("b", IntegerType())])


@dataclass(frozen=True)
class Manifest:
    number: int
    query_id: str = ""
    batch_id: int = -1
    next_write: int = 0
    buckets: dict[str, list[list[int]]] = field(default_factory=dict)   # bucket -> [[write, rows], ...], base first
    live: dict[str, int] = field(default_factory=dict)                  # bucket -> rows of the table
    done: dict[str, int] = field(default_factory=dict)                  # query -> newest batch
    clears: dict[str, str] = field(default_factory=dict)                # model -> newest clear applied
    first_write: dict[str, str] = field(default_factory=dict)           # model -> earliest time
    n_buckets: int = BUCKETS
    open_windows: dict | None = None                                    # write, until and window lengths
    dimensions: dict[str, str] = field(default_factory=dict)            # model -> dimension of its rows
    epochs: list[list] = field(default_factory=list)                    # closed: [model, dimension, write]
    dropped: list[int] = field(default_factory=list)                    # writes of dropped records
    at: float = 0.0                                                     # clock of the commit, in seconds

    def folders(self) -> set[tuple[int, int]]:
        return {(w, int(b)) for b, entries in self.buckets.items() for w, _ in entries}


class ResultStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, key: list[str] | None = None):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key or KEY_WITH_DIRECTION, buckets

    # ---- files ----

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs()
        at = path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _manifest_file(self, number: int) -> str:
        return f"{self.root}/manifests/{number:020d}.json"

    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("manifests") if n.endswith(".json") and not n.startswith(".")]

    def manifest(self, number: int | None = None) -> Manifest | None:
        """One version; the newest by default, None if there is none."""
        if number is None:
            numbers = self._numbers()
            if not numbers:
                return None
            number = numbers[-1]
        fs, path = self._fs()
        stream = fs.open(path(self._manifest_file(number)))
        try:
            return Manifest(**json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _publish(self, m: Manifest) -> None:
        fs, path = self._fs()
        aside, final = path(f"{self.root}/manifests/.{uuid.uuid4().hex}"), path(self._manifest_file(m.number))
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps(m.__dict__).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(aside, final):
            raise RuntimeError(f"version {m.number} of {self.root} is there already: another writer is at work")

    # ---- reading ----

    def versions(self) -> list[Manifest]:
        """The versions kept, oldest first (for tests and maintenance; readers and writers need one)."""
        return [self.manifest(n) for n in self._numbers()]

    def find(self, query_id: str, batch_id: int) -> Manifest | None:
        """The newest version, if this micro-batch of this query is in it."""
        m = self.manifest()
        return m if m is not None and m.done.get(query_id, -1) >= batch_id else None

    def _rows(self, folders: list[tuple[int, int]]) -> DataFrame:
        """Rows as written, with their write ``w`` and bucket ``b``."""
        return (self.spark.read.schema(_STORED).option("basePath", f"{self.root}/data")
                .parquet(*(f"{self.root}/data/w={w}/b={b}" for w, b in sorted(folders))))

    def _merged(self, m: Manifest, buckets: list[str]) -> DataFrame | None:
        """The table's rows of some buckets, with ``b``; only buckets with changes are reduced by key."""
        plain = [(m.buckets[b][0][0], int(b)) for b in buckets if len(m.buckets[b]) == 1]
        changed = [(w, int(b)) for b in buckets if len(m.buckets[b]) > 1 for w, _ in m.buckets[b]]
        out = self._rows(plain).drop("w") if plain else None
        if changed:
            rest = [c for c in RESULT_COLUMNS if c not in self.key]
            newest = (self._rows(changed).groupBy("b", *self.key).agg(F.max_by(F.struct(*rest), "w").alias("r"))
                      .select(*self.key, "r.*", "b"))
            out = newest if out is None else out.unionByName(newest)
        return out

    def read(self, number: int) -> DataFrame:
        return self.table(self.manifest(number))

    def table(self, m: Manifest) -> DataFrame:
        from netbaseline.operators.profile import empty_results
        rows = self._merged(m, sorted(m.buckets, key=int))
        return empty_results(self.spark) if rows is None else rows.select(*RESULT_COLUMNS)

    def latest(self) -> DataFrame | None:
        m = self.manifest()
        return None if m is None else self.table(m)

    def closed(self) -> DataFrame | None:
        """Rows of closed epochs, with ``epoch`` (0, 1, ... per model) and the ``dimension`` they were built for."""
        m, out, number = self.manifest(), None, {}
        for model, dim, write in (m.epochs if m is not None else []):
            rows = (self.spark.read.schema(RESULT_SCHEMA).parquet(f"{self.root}/closed/w={write}")
                    .withColumn("epoch", F.lit(number.setdefault(model, 0))).withColumn("dimension", F.lit(dim)))
            number[model] += 1
            out = rows if out is None else out.unionByName(rows)
        return out

    def bucket(self, n_buckets: int) -> Column:
        return F.pmod(F.xxhash64(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in self.key)),
                      F.lit(n_buckets).cast("long")).cast("int")

    def touched(self, m: Manifest, keys: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame | None:
        """The table's rows with one of ``keys``, from the buckets that have any."""
        keys = keys.select(*(F.col(k).alias(f"k_{k}") for k in self.key), self.bucket(m.n_buckets).alias("k_b"))
        wanted = {str(r[0]) for r in keys.select("k_b").distinct().collect()}   # at most the number of buckets
        rows = self._merged(m, [b for b in sorted(m.buckets, key=int) if b in wanted])
        if rows is None:
            return None
        same = rows["b"] == F.col("k_b")
        for k in self.key:
            same &= rows[k].eqNullSafe(F.col(f"k_{k}"))
        return rows.join(F.broadcast(keys) if is_small(keys, max_broadcast_rows) else keys, same, "left_semi").select(*RESULT_COLUMNS)

    def open_windows(self, m: Manifest | None) -> OpenWindows | None:
        """The windows that earlier batches left open."""
        if m is None or m.open_windows is None:
            return None
        read = lambda level: self.spark.read.parquet(f"{self.root}/open/w={m.open_windows['write']}/{level}")
        return OpenWindows(read("level1"), read("level2"), m.open_windows["until"])

    # ---- writing ----

    def _write(self, rows: DataFrame, write: int, n_buckets: int) -> DataFrame:
        path = f"{self.root}/data/w={write}"
        (rows.select(*RESULT_COLUMNS, self.bucket(n_buckets).alias("b")).repartition("b")
         .write.mode("overwrite").partitionBy("b").parquet(path))
        return self.spark.read.schema(_STORED).option("basePath", f"{self.root}/data").parquet(path)

    def commit(self, changed: DataFrame | None, query_id: str = "", batch_id: int = -1, clears: dict[str, str] | None = None,
               drop_models: list[str] = (), replaced: DataFrame | None = None,
               held: OpenWindows | None = None, lengths: tuple[int, int] | None = None,
               close: dict[str, str] | None = None, dimensions: dict[str, str] | None = None,
               dropped: DataFrame | None = None, last: bool = True) -> Manifest:
        """Write a version in which the rows ``changed`` (None: no rows) replace those of their keys; returns its manifest.

        ``replaced``: the rows of those keys in the version before
        (:meth:`touched`).  ``drop_models``: models whose other rows go;
        ``close``: models (and the dimension so far) whose other rows are kept
        aside as a closed epoch.  ``held``: the windows left open, with their
        window ``lengths``.  ``dimensions``: of the models written.
        ``dropped``: records left out, ``DROPPED`` columns.  A batch of several
        commits is done with its ``last``.
        """
        old = self.manifest() or Manifest(-1, n_buckets=self.buckets)
        n, write = old.n_buckets, old.next_write
        buckets = {b: [list(e) for e in entries] for b, entries in old.buckets.items()}
        close, epochs = close or {}, [list(e) for e in old.epochs]
        gone = sorted({*drop_models, *close})
        live, first = dict(old.live), {k: v for k, v in old.first_write.items() if k not in gone}
        if gone and buckets:
            for model in sorted(set(close) - set(drop_models)):
                self._merged(old, list(buckets)).where(F.col("modeling_params_id") == model).select(*RESULT_COLUMNS).write.mode(
                    "overwrite").parquet(f"{self.root}/closed/w={write}")
                epochs.append([model, close[model], write])
                write += 1
            rest = self._merged(old, list(buckets)).where(~F.col("modeling_params_id").isin(gone))
            counts = self._write(rest, write, n).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()
            buckets = {str(r["b"]): [[write, r["n"]]] for r in counts}
            live, write = {str(r["b"]): r["n"] for r in counts}, write + 1
        before = {}
        if replaced is not None:
            before = {str(r["b"]): r["n"] for r in replaced.groupBy(self.bucket(n).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
        told = [] if changed is None else (
            self._write(changed, write, n).groupBy("b", "modeling_params_id")
            .agg(F.count(F.lit(1)).alias("n"), F.date_format(F.min("time"), TIME).alias("t")).collect())
        sizes: dict[str, int] = {}
        for r in told:                                     # at most one row per bucket and model
            sizes[str(r["b"])] = sizes.get(str(r["b"]), 0) + r["n"]
            first[r["modeling_params_id"]] = min(r["t"], first.get(r["modeling_params_id"], r["t"]))
        for b, size in sizes.items():
            known = before.get(b, 0)
            whole = known == live.get(b, 0)                # every row of the bucket comes anew
            buckets[b] = [[write, size]] if whole else buckets[b] + [[write, size]]
            live[b] = live.get(b, 0) + size - known
        write += 1
        full = [b for b, e in buckets.items() if len(e) > 1
                and (len(e) > MAX_CHANGES or sum(x[1] for x in e[1:]) > COMPACT_SHARE * e[0][1])]
        new = replace(old, number=old.number + 1, query_id=query_id, batch_id=batch_id, buckets=buckets, live=live,
                      first_write=first, done=old.done | ({query_id: batch_id} if last else {}), at=time.time(), clears=old.clears | (clears or {}),
                      dimensions=old.dimensions | (dimensions or {}), epochs=epochs)
        if full:
            counts = self._write(self._merged(new, full), write, n).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()
            for r in counts:
                buckets[str(r["b"])] = [[write, r["n"]]]
            write += 1
        if held is not None:
            folder = f"{self.root}/open/w={write}"
            held.level1.write.mode("overwrite").parquet(f"{folder}/level1")
            held.level2.write.mode("overwrite").parquet(f"{folder}/level2")
            new = replace(new, open_windows={"write": write, "until": held.until, "lengths": list(lengths or ())})
            write += 1
        if dropped is not None:
            entries = [*new.dropped, write]
            if len(entries) > MAX_DROPPED:           # one table again
                dropped = self._dropped(new.dropped).unionByName(dropped).groupBy("reason", "window_start").agg(F.sum("n").alias("n"))
                entries = [write]
            dropped.select(*DROPPED).write.mode("overwrite").parquet(f"{self.root}/dropped/w={write}")
            new, write = replace(new, dropped=entries), write + 1
        new = replace(new, buckets=buckets, next_write=write)
        self._publish(new)
        return new

    def _dropped(self, writes: list[int]) -> DataFrame:
        return self.spark.read.schema("reason string, window_start timestamp, n long").parquet(
            *(f"{self.root}/dropped/w={w}" for w in writes))

    def dropped(self) -> DataFrame | None:
        """``(reason, window_start, n)``: the records left out so far, each batch's exactly once."""
        m = self.manifest()
        if m is None or not m.dropped:
            return None
        return self._dropped(m.dropped).groupBy("reason", "window_start").agg(F.sum("n").cast("long").alias("n"))

    def expire(self, keep: int) -> None:
        """Remove all but the newest ``keep`` versions and the folders that only they name."""
        numbers = self._numbers()
        if keep <= 0 or len(numbers) <= keep:
            return
        fs, path = self._fs()
        kept = [self.manifest(n) for n in numbers[-keep:]]
        for n in numbers[:-keep]:                          # first, so that no version names a folder that is gone
            fs.delete(path(self._manifest_file(n)), False)
        used = set().union(*(m.folders() for m in kept))
        newest = kept[-1].next_write
        for name in self._names("data"):
            w = int(name.partition("=")[2])
            here = [x for x in self._names(f"data/{name}") if x.startswith("b=")]
            if w < newest:
                gone = [x for x in here if (w, int(x[2:])) not in used]
                for x in (gone if len(gone) < len(here) else []):
                    fs.delete(path(f"{self.root}/data/{name}/{x}"), True)
                if len(gone) == len(here):
                    fs.delete(path(f"{self.root}/data/{name}"), True)
        windows = {m.open_windows["write"] for m in kept if m.open_windows}
        for name in self._names("open"):
            w = int(name.partition("=")[2])
            if w < newest and w not in windows:
                fs.delete(path(f"{self.root}/open/{name}"), True)
