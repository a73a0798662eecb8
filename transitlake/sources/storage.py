"""A store of files below a root, through Hadoop's file systems, so that every scheme Spark can read works alike."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from fnmatch import fnmatch

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Root:
    """Where a store lies, the Hadoop settings that reach it, and how Arrow does: a kind of file system and its arguments.

    ``bucket`` is made if it is not there yet.
    """

    uri: str
    conf: dict[str, str] = field(default_factory=dict)
    arrow: tuple[str, dict] | None = None
    bucket: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder that all machines see, from ``spark.checkpoint.dir``. Only where driver and executors are one machine, a temporary one if that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines see")
        root = tempfile.mkdtemp(prefix="transitlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def arrow_files(arrow: tuple[str, dict] | None) -> pafs.FileSystem | None:
    """Arrow's file system of a root, which reads ranges of files; none if Arrow does not know the scheme."""
    kinds = {"file": pafs.LocalFileSystem, "s3": getattr(pafs, "S3FileSystem", None), "gs": getattr(pafs, "GcsFileSystem", None)}
    return kinds[arrow[0]](**arrow[1]) if arrow and kinds.get(arrow[0]) else None


def arrow_path(uri: str) -> str:
    """A URI's path as Arrow's file systems take it: a local one from the root, others from the bucket."""
    scheme, _, rest = uri.partition(":")
    return "/" + rest.lstrip("/") if scheme == "file" else rest.lstrip("/")


def make_bucket(root: Root) -> bool:
    """Makes the root's bucket if it is not there; whether it did."""
    fs = arrow_files(root.arrow) if root.bucket else None
    if fs is None or fs.get_file_info(root.bucket).type != pafs.FileType.NotFound:
        return False
    fs.create_dir(root.bucket, recursive=False)
    return True


def _needed(kind: str, params: dict, names: tuple[str, ...]) -> None:
    if missing := [n for n in names if not params.get(n)]:
        raise ValueError(f"{kind} storage needs {', '.join(missing)}")


def _below(base: str, path: str) -> str:
    path = (path or "").strip("/")
    return f"{base}/{path}" if path else base


def _filesystem(base_directory: str = "") -> Root:
    return Root("file://" + os.path.abspath(base_directory or "."), arrow=("file", {}))


def _gcs(bucket_name: str = "", base_path: str = "") -> Root:
    _needed("gcs", {"bucket_name": bucket_name}, ("bucket_name",))
    return Root(_below(f"gs://{bucket_name}", base_path), arrow=("gs", {}))


def _s3(endpoint: str = "", access_key: str = "", secret_key: str = "", bucket_name: str = "", secure: bool = True, base_path: str = "") -> Root:
    _needed("minio", {"endpoint": endpoint, "access_key": access_key, "secret_key": secret_key, "bucket_name": bucket_name}, ("endpoint", "access_key", "secret_key", "bucket_name"))
    conf = {"endpoint": endpoint, "access.key": access_key, "secret.key": secret_key, "connection.ssl.enabled": str(bool(secure)).lower(), "path.style.access": "true"}
    # per bucket, so that stores with other keys can live in one session
    arrow = ("s3", {"access_key": access_key, "secret_key": secret_key, "endpoint_override": re.sub("^https?://", "", endpoint), "scheme": "https" if secure else "http", "allow_bucket_creation": True, "connect_timeout": 10, "request_timeout": 60})
    return Root(_below(f"s3a://{bucket_name}", base_path), {f"fs.s3a.bucket.{bucket_name}.{k}": v for k, v in conf.items()}, arrow, bucket_name)


#: Resolvers by lower-case name; more can be registered.
RESOLVERS: dict[str, Callable[..., Root]] = {"filesystem": _filesystem, "gcs": _gcs, "google": _gcs, "google_cloud_storage": _gcs, "minio": _s3, "s3": _s3}


def register_storage_type(name: str, resolver: Callable[..., Root]) -> None:
    """Adds a kind of storage: ``resolver(**params)`` gives its root."""
    RESOLVERS[name.lower()] = resolver


def _resolver(kind: str) -> Callable[..., Root]:
    if kind.lower() not in RESOLVERS:
        raise ValueError(f"no storage type {kind!r}; there are {', '.join(sorted(RESOLVERS))}")
    return RESOLVERS[kind.lower()]


def resolve_root(kind: str, **params) -> Root:
    """The root of a kind of storage; parameters that it does not know are refused."""
    try:
        return _resolver(kind)(**params)
    except TypeError as e:
        raise ValueError(f"{kind} storage: {e}") from None


def create_storage(spark: SparkSession, kind: str, **params) -> Storage:
    """The store of that kind; parameters that it does not know are ignored."""
    resolver = _resolver(kind)
    code = getattr(resolver, "__code__", None)
    known = set(code.co_varnames[: code.co_argcount + code.co_kwonlyargcount]) if code and not code.co_flags & 0x08 else None
    return Storage(spark, resolver(**{k: v for k, v in params.items() if known is None or k in known}))


def create_storage_from_config(spark: SparkSession, kind: str, params: dict) -> Storage:
    return Storage(spark, resolve_root(kind, **params))


class Storage:
    """Files by path below a root. A failed write raises; a file is there whole or not at all."""

    def __init__(self, spark: SparkSession, root: Root | str):
        self.spark, self.root = spark, root if isinstance(root, Root) else Root(root, arrow=("file", {}) if root.startswith("file:") else None)
        make_bucket(self.root)
        jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        for k, v in self.root.conf.items():
            conf.set(k, v)
        self._path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self.fs = self._path(self.root.uri).getFileSystem(conf)

    def uri(self, path: str) -> str:
        return f"{self.root.uri.rstrip('/')}/{path.lstrip('/')}"

    def _at(self, path: str):
        return self._path(self.uri(path))

    def key(self, path: str, encoded: bool = False) -> str:
        """The path's URI as Spark reports it, without the scheme; ``encoded`` as in ``_metadata.file_path``."""
        at = self.fs.makeQualified(self._at(path))
        return re.sub("^[A-Za-z0-9]+:/*", "/", at.toUri().toString() if encoded else at.toString())

    def relative(self, uri: str) -> str:
        """The path below the root of a URI that Spark or Hadoop gave, however many slashes its scheme has."""
        plain = lambda u: u.split(":", 1)[-1].lstrip("/")
        return plain(uri)[len(plain(self.root.uri).rstrip("/")) :].lstrip("/")

    def save_bytes(self, data: bytes, path: str) -> str:
        """Writes, replacing what is there; returns the full path."""
        temporary = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
        out = self.fs.create(self._at(temporary), True)
        try:
            out.write(data)
        finally:
            out.close()
        self.rename_file(temporary, path, replace=True)
        return self.uri(path)

    def read_bytes(self, path: str) -> bytes:
        """The contents; a missing file raises FileNotFoundError."""
        if not self.file_exists(path):
            raise FileNotFoundError(self.uri(path))
        stream = self.fs.open(self._at(path))
        try:
            return bytes(self._io.toByteArray(stream))
        finally:
            stream.close()

    def list_files(self, directory: str, pattern: str = "*", recursive: bool = False) -> list[str]:
        """Sorted paths below the root of a directory's files; a missing directory has none; hidden files do not count."""
        at = self._at(directory)
        if not self.fs.exists(at):
            return []
        found, files = [], self.fs.listFiles(at, recursive)
        while files.hasNext():
            p = files.next().getPath()
            if fnmatch(p.getName(), pattern) and not p.getName().startswith((".", "_")):
                found.append(self.relative(p.toString()))
        return sorted(found)

    def delete_file(self, path: str) -> bool:
        """Whether there was a file to delete."""
        return self.fs.delete(self._at(path), False) if self.file_exists(path) else False

    def delete_directory(self, path: str) -> bool:
        return self.fs.delete(self._at(path), True)

    def rename_file(self, old: str, new: str, replace: bool = False) -> bool:
        """Moves a file, making directories; without ``replace`` an existing target stays and False comes back."""
        if not self.file_exists(old):
            return False
        target = self._at(new)
        if self.fs.exists(target):
            if not replace:
                return False
            self.fs.delete(target, False)
        self.fs.mkdirs(target.getParent())
        return self.fs.rename(self._at(old), target)

    def file_exists(self, path: str) -> bool:
        at = self._at(path)
        return self.fs.exists(at) and self.fs.getFileStatus(at).isFile()

    def create_once(self, path: str, data: bytes = b"") -> bool:
        """Creates a file unless it exists already; whether it did."""
        from py4j.protocol import Py4JJavaError

        try:
            out = self.fs.create(self._at(path), False)
        except Py4JJavaError:
            if self.fs.exists(self._at(path)):
                return False
            raise
        out.write(data)
        out.close()
        return True

    def rewrite(self, path: str, data: bytes) -> None:
        """Writes a small file in its place, so that it is never absent."""
        out = self.fs.create(self._at(path), True)
        out.write(data)
        out.close()

    def age_seconds(self, path: str) -> float:
        import time

        return time.time() - self.fs.getFileStatus(self._at(path)).getModificationTime() / 1000
