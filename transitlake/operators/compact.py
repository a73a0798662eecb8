"""Compaction: the landed files of each closed bucket become one object, and are then deleted.

All closed buckets of a directory are read, dealt out by bucket and written by one Spark job. What happens next is a redo
log: a manifest names the staged object, its place and its inputs; it is finished by moving the object and deleting the
inputs, here or by the next run, so that a crash in between neither loses nor doubles rows.
"""

from __future__ import annotations

import io
import json
import logging
import threading
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timebucket as tb
from ..sources.sinks import parquet_options
from ..sources.storage import Storage, arrow_files, arrow_path
from .files import closed_groups

logger = logging.getLogger(__name__)
#: A lock older than this was left by a run that died; one that lives renews its lock four times in that time.
LOCK_SECONDS = 1800
#: Calls of the store that are under way at a time, and files whose footers a task reads.
CALLS, FOOTERS = 16, 64


@dataclass(frozen=True)
class Compacted:
    """What became of a bucket; ``output`` is None if all of its files were empty or unreadable."""

    group_time: str
    output: str | None
    n_files: int
    n_rows: int
    quarantined: tuple[str, ...]


def _readable(schema: pa.Schema) -> pa.Schema:
    """The schema with microseconds for nanoseconds and signed numbers for unsigned ones, and without metadata."""

    def kind(t: pa.DataType) -> pa.DataType:
        if pa.types.is_timestamp(t):
            return pa.timestamp("us", t.tz)
        if pa.types.is_unsigned_integer(t):
            return pa.int64() if t.bit_width >= 32 else pa.int32()
        if pa.types.is_dictionary(t):
            return kind(t.value_type)
        return t

    return pa.schema([pa.field(f.name, kind(f.type)) for f in schema])


def _opened(spark: SparkSession, uris: list[str], arrow: tuple[str, dict] | None) -> DataFrame:
    """(path, content): files to be read on the executors. Content is null where Arrow can open the path itself and read what it needs of it."""
    if arrow_files(arrow) is None:
        return spark.read.format("binaryFile").load(uris).select("path", "content")
    paths = spark.createDataFrame([(u,) for u in uris], "path string").repartition(-(-len(uris) // FOOTERS))
    return paths.withColumn("content", F.lit(None).cast("binary"))


def footers(spark: SparkSession, uris: list[str], arrow: tuple[str, dict] | None = None) -> DataFrame:
    """(path, readable, n_rows, footer, arrow): each file's row count and schema, without metadata, read on the executors.

    Where Arrow knows the store only the files' ends are read, else whole files through Spark. ``arrow`` is null where Spark
    can read the file itself; else, for nanoseconds and Brotli, it is the schema to read it with.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        fs = arrow_files(arrow)
        for batch in batches:
            rows = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    with fs.open_input_file(arrow_path(path)) if content is None else io.BytesIO(content) as source:
                        f = pq.ParquetFile(source)
                        meta, schema = f.metadata, f.schema_arrow.remove_metadata()
                        footer = schema.to_string(show_field_metadata=False)
                        odd = "[ns" in footer or any(meta.row_group(g).column(c).compression == "BROTLI" for g in range(meta.num_row_groups) for c in range(meta.num_columns))
                        rows.append((True, meta.num_rows, footer, _readable(schema).serialize().to_pybytes() if odd else None))
                except (pa.ArrowException, OSError):
                    rows.append((False, 0, "", None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.bool_(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("path"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["path", "readable", "n_rows", "footer", "arrow"])

    return _opened(spark, uris, arrow).mapInArrow(run, "path string, readable boolean, n_rows long, footer string, arrow binary")


def read_foreign(spark: SparkSession, uris: list[str], arrow: bytes, where: tuple[str, dict] | None = None) -> DataFrame:
    """Files that Spark's own reader does not take, read by Arrow on the executors, one at a time, with ``_key``."""
    from pyspark.sql.pandas.types import from_arrow_schema

    schema = pa.ipc.read_schema(pa.py_buffer(arrow))
    kind = T.StructType([T.StructField("_path", T.StringType()), *from_arrow_schema(schema, prefer_timestamp_ntz=True).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        wanted, fs = pa.ipc.read_schema(pa.py_buffer(arrow)), arrow_files(where)
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with fs.open_input_file(arrow_path(path)) if content is None else io.BytesIO(content) as source:
                    for rows in pq.ParquetFile(source).iter_batches():
                        table = pa.Table.from_batches([rows]).select(wanted.names).cast(wanted, safe=False)
                        named = table.add_column(0, "_path", pa.array([path] * rows.num_rows, pa.string()))
                        yield from named.combine_chunks().to_batches()

    return _opened(spark, uris, where).mapInArrow(run, kind).withColumn("_key", _key(F.col("_path"))).drop("_path")


def judged(files: DataFrame, schema_mode: str = "strict") -> DataFrame:
    """(group_time, path, readable, n_rows, footer, ...) with ``kind``, the schema as Spark
    reads it, and ``good``: whether a file goes into its bucket's object.

    The first readable file with rows, by path, fixes the bucket's schema. In strict mode a file with rows whose columns
    differ by name, order, type or nullability is not good; an empty one is only passed over. With ``promote`` all readable
    files are good.
    """
    if schema_mode not in ("strict", "promote"):
        raise ValueError(f"schema_mode is strict or promote, not {schema_mode!r}")
    full = F.col("readable") & (F.col("n_rows") > 0)
    # an object that this module wrote has no unsigned numbers and nothing that cannot be null
    merged = F.max(F.col("path").startswith("0")).over(Window.partitionBy("group_time"))
    files = files.withColumn("kind", F.regexp_replace(F.regexp_replace("footer", " not null", ""), "uint(32|64)", "int64")).withColumn("kind", F.regexp_replace("kind", r"timestamp\[ns", "timestamp[us"))
    files = files.withColumn("_held", F.when(merged, F.col("kind")).otherwise(F.col("footer")))
    first = F.first(F.when(full, F.col("_held")), ignorenulls=True).over(Window.partitionBy("group_time").orderBy("path").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    same = F.lit(True) if schema_mode == "promote" else (F.col("n_rows") == 0) | (F.col("_held") == F.col("_first"))
    return files.withColumn("_first", first).withColumn("good", F.col("readable") & F.coalesce(same, F.lit(True))).drop("_first", "_held")


def _key(uri: Column) -> Column:
    """A file's URI without its scheme, which is written with one slash or three."""
    return F.regexp_replace(uri, "^[A-Za-z0-9]+:/*", "/")


def _plain(df: DataFrame) -> DataFrame:
    """Unsigned 64-bit numbers, which Spark reads as decimals, as ``bigint``."""
    wide = T.DecimalType(20, 0)
    return df.select(*[F.col(f"`{f.name}`").cast("bigint").alias(f.name) if f.dataType == wide else F.col(f"`{f.name}`") for f in df.schema.fields])


def union_all(frames: list[DataFrame], promote: bool = False) -> DataFrame:
    """UNION ALL: by position of equal columns, or by name with nulls for missing ones."""
    out = frames[0]
    for df in frames[1:]:
        if not promote and df.columns != out.columns:
            raise ValueError(f"columns differ: {out.columns} and {df.columns}")
        out = out.unionByName(df, allowMissingColumns=promote)
    return out


class Lock:
    """A lock on a directory, held by a file that names its owner and is written anew while the run lives."""

    def __init__(self, storage: Storage, directory: str):
        self.storage, self.path, self.owner = storage, f"{directory}/_lock", uuid.uuid4().hex.encode()
        self._ended, self._busy = threading.Event(), threading.Lock()

    def take(self) -> bool:
        """Whether this run alone may work on the directory."""
        mine = self.storage.create_once(self.path, self.owner)
        if not mine and self.storage.age_seconds(self.path) > LOCK_SECONDS:
            self.storage.delete_file(self.path)
            mine = self.storage.create_once(self.path, self.owner)
        if mine:
            threading.Thread(target=self._keep, daemon=True).start()
        return mine

    def _keep(self) -> None:
        while not self._ended.wait(LOCK_SECONDS / 4):
            if not self.held():
                return
            with self._busy:
                self.storage.rewrite(self.path, self.owner)

    def held(self) -> bool:
        """Whether the lock is still this run's own."""
        with self._busy:
            return self.storage.file_exists(self.path) and self.storage.read_bytes(self.path) == self.owner

    def check(self) -> None:
        """Raises if another run has taken the lock: nothing may be moved or deleted any more."""
        if not self.held():
            raise RuntimeError(f"{self.path} belongs to another run")

    def release(self) -> None:
        self._ended.set()
        if self.held():
            self.storage.delete_file(self.path)


@contextmanager
def lock(storage: Storage, directory: str) -> Iterator[Lock | None]:
    """The directory's lock, or None if another run has it."""
    own = Lock(storage, directory)
    mine = own.take()
    try:
        yield own if mine else None
    finally:
        if mine:
            own.release()


def _finish(storage: Storage, manifest: str) -> None:
    """Carries out what a manifest says; running it again changes nothing."""
    said = json.loads(storage.read_bytes(manifest))
    if said["staged"] and storage.file_exists(said["staged"]):
        storage.rename_file(said["staged"], said["output"], replace=True)
    for path in said["quarantine"]:
        head, _, tail = path.rpartition("/individual/")
        storage.rename_file(path, f"{head}/error/{tail}", replace=True)
    for path in said["inputs"]:
        storage.delete_file(path)
    storage.delete_file(manifest)


def _each(call, items: list) -> list:
    """``call`` of each item, some at a time: the store answers from afar."""
    with ThreadPoolExecutor(CALLS) as pool:
        return list(pool.map(call, items))


def recover(storage: Storage, directory: str) -> int:
    """Finishes what an earlier run began; how many buckets that were."""
    manifests = storage.list_files(f"{directory}/_manifests", "*.json")
    _each(lambda manifest: _finish(storage, manifest), manifests)
    return len(manifests)


def compact(
    storage: Storage, provider: str, service: str, minutes: int, zone: str = "UTC", schema_mode: str = "strict", late: str = "merge", force: bool = False,
    compression: str = "zstd", filename_format: str = "{group_time}_to_{next_period}.parquet", time_format: str = "%H-%M-%S",
) -> list[Compacted]:
    """Compacts the closed buckets of a provider's service.

    ``schema_mode``: ``strict`` moves files that do not match their bucket to ``error/``; ``promote`` fills missing columns
    with null. ``late``: files that come after their bucket's object was made are merged into it, or ``overwrite`` it.
    ``force`` compacts open buckets too. Names without a time stay where they are.
    """
    if late not in ("merge", "overwrite"):
        raise ValueError(f"late is merge or overwrite, not {late!r}")
    spark, directory = storage.spark, f"{provider}/{service}"
    if not storage.list_files(f"{directory}/individual", "*.parquet") and not storage.list_files(f"{directory}/_manifests", "*.json"):
        return []
    with lock(storage, directory) as mine:
        if mine is None:
            logger.info("%s is being compacted elsewhere", directory)
            return []
        recover(storage, directory)
        paths = storage.list_files(f"{directory}/individual", "*.parquet")
        if not paths:
            return []
        groups = closed_groups(spark.createDataFrame([(p,) for p in paths], "path string"), minutes, zone, force)
        groups = groups.select("path", tb.wall_clock(F.col("group_time")).alias("g")).collect()  # a listing, file by file
        if not groups:
            return []
        group_of = {r["path"]: r["g"] for r in groups}
        starts = {g: datetime.fromisoformat(g) for g in sorted(set(group_of.values()))}
        outputs = {g: tb.output_path(provider, service, t, minutes, filename_format, time_format) for g, t in starts.items()}
        if late == "merge":
            # an object that is there already goes in first, so that its schema holds
            there = _each(storage.file_exists, list(outputs.values()))
            group_of |= {o: g for (g, o), found in zip(outputs.items(), there, strict=True) if found}
        order = {p: f"{int('/individual/' in p)}{p}" for p in group_of}
        found = footers(spark, [storage.uri(p) for p in group_of], storage.root.arrow)
        known = spark.createDataFrame([(p, g, order[p], storage.key(p)) for p, g in group_of.items()], "file string, group_time string, sort string, _key string")
        both = known.join(found.withColumn("_key", _key(F.col("path"))).drop("path"), "_key", "left").drop("_key").withColumnRenamed("sort", "path")
        rows = judged(both.fillna({"readable": False, "n_rows": 0, "footer": ""}), schema_mode).collect()
        aside = f"{directory}/_staging/{uuid.uuid4().hex}"
        by_schema: dict[tuple[str, str, bool], list] = {}
        by_group: dict[str, list] = {g: [] for g in starts}
        for r in rows:
            by_group[r["group_time"]].append(r)
            if r["good"] and r["n_rows"]:
                by_schema.setdefault((r["kind"] if schema_mode == "strict" else "", r["footer"], r["arrow"] is None), []).append(r)
        number = {g: i for i, g in enumerate(starts)}
        by_kind: dict[str, list[DataFrame]] = {}
        for (kind, *_), files in by_schema.items():
            uris, foreign = [storage.uri(r["file"]) for r in files], files[0]["arrow"]
            if foreign is None:
                read = _plain(spark.read.parquet(*uris).withColumn("_key", _key(F.col("_metadata.file_path"))))
            else:
                read = read_foreign(spark, uris, bytes(foreign), storage.root.arrow)
            place = spark.createDataFrame([(storage.key(r["file"], encoded=foreign is None), number[r["group_time"]], r["path"]) for r in files], "_key string, _group int, _sort string")
            by_kind.setdefault(kind, []).append(read.join(F.broadcast(place), "_key").drop("_key"))  # a row per file of a listing
        # files of a bucket are of one kind, unless kinds are promoted to one
        for k, frames in enumerate(by_kind.values()):
            df = union_all(frames, promote=schema_mode == "promote")
            out = df.repartition(max(1, min(len(number), 2000)), "_group").sortWithinPartitions("_group", "_sort").drop("_sort")
            out.write.partitionBy("_group").options(**parquet_options(compression)).parquet(storage.uri(f"{aside}/{k}"))
        staged = {}
        for path in storage.list_files(aside, "part-*.parquet", recursive=True):
            staged[int(path.split("_group=")[1].split("/")[0])] = path

        def finish(g: str) -> Compacted | None:
            own, output = by_group[g], outputs[g]
            bad = [r["file"] for r in own if not r["good"] and "/individual/" in r["file"]]
            spoilt = [r["file"] for r in own if not r["good"] and "/individual/" not in r["file"]]
            if spoilt:
                # the bucket's object itself does not fit: nothing is replaced, and its late files wait
                logger.error("%s cannot be merged into", spoilt[0])
                return None
            inputs = [r["file"] for r in own if r["good"] and "/individual/" in r["file"]]
            piece = staged.get(number[g])
            manifest = f"{directory}/_manifests/{starts[g]:%Y-%m-%d_%H-%M-%S}.json"
            mine.check()
            storage.save_bytes(json.dumps({"staged": piece, "output": output, "inputs": inputs, "quarantine": bad}).encode(), manifest)
            _finish(storage, manifest)
            n = sum(r["n_rows"] for r in own if r["good"])
            if inputs:
                logger.info("%s: %d rows of %d files, %d each", output, n, len(inputs), round(n / len(inputs)))
            return Compacted(g, output if piece else None, len(inputs), n, tuple(bad))

        done = [x for x in _each(finish, list(starts)) if x]
        storage.delete_directory(aside)
        return done
