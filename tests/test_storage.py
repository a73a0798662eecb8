import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from datetime import datetime

from transitlake.sources import storage as S
from transitlake.sources.sinks import LandingBuffer, land, parquet_options, write_single


@pytest.fixture
def store(spark, tmp_path):
    return S.create_storage(spark, "FileSystem", base_directory=str(tmp_path / "a b"), unknown=1)


def test_files(store):
    assert store.list_files("x") == [] and not store.file_exists("x/a.txt") and not store.delete_file("x/a.txt")
    assert store.save_bytes(b"one", "x/a.txt").endswith("a b/x/a.txt")
    store.save_bytes(b"two", "x/a.txt")
    store.save_bytes(b"", "x/deep/b.txt")
    assert store.read_bytes("x/a.txt") == b"two" and store.read_bytes("x/deep/b.txt") == b""
    assert store.list_files("x") == ["x/a.txt"] and store.list_files("x", "*.pq") == []
    assert store.list_files("x", "*.txt", recursive=True) == ["x/a.txt", "x/deep/b.txt"]
    assert store.rename_file("x/a.txt", "y/z/c.txt") and store.file_exists("y/z/c.txt") and not store.file_exists("x/a.txt")
    store.save_bytes(b"new", "x/a.txt")
    assert not store.rename_file("x/a.txt", "y/z/c.txt") and store.rename_file("x/a.txt", "y/z/c.txt", replace=True)
    assert store.read_bytes("y/z/c.txt") == b"new" and not store.rename_file("none", "other")
    assert not store.file_exists("y/z") and store.delete_file("y/z/c.txt")
    with pytest.raises(FileNotFoundError):
        store.read_bytes("y/z/c.txt")
    assert store.create_once("lock") and not store.create_once("lock") and store.age_seconds("lock") < 60


def test_roots():
    assert S.resolve_root("GCS", bucket_name="b", base_path="/x/").uri == "gs://b/x"
    assert S.resolve_root("google", bucket_name="b").uri == S.resolve_root("google_cloud_storage", bucket_name="b").uri == "gs://b"
    root = S.resolve_root("minio", endpoint="e:9000", access_key="a", secret_key="s", bucket_name="b", secure=False, base_path="p")
    assert root.uri == "s3a://b/p" and root.conf["fs.s3a.bucket.b.endpoint"] == "e:9000" and root.conf["fs.s3a.bucket.b.connection.ssl.enabled"] == "false" and root.conf["fs.s3a.bucket.b.path.style.access"] == "true"
    with pytest.raises(ValueError, match="access_key, secret_key, bucket_name"):
        S.resolve_root("s3", endpoint="e")
    with pytest.raises(ValueError, match="bucket_name"):
        S.resolve_root("gcs")
    with pytest.raises(ValueError, match="no storage type"):
        S.resolve_root("tape")
    with pytest.raises(ValueError, match="unexpected"):
        S.resolve_root("gcs", bucket_name="b", colour="red")


class Buckets(BaseHTTPRequestHandler):
    """As much of an object store as making a bucket takes."""

    made: list[str] = []

    def do_HEAD(self):
        self.send_response(200 if self.path.strip("/") in self.made else 404)
        self.end_headers()

    def do_GET(self):
        body = b"<ListBucketResult><KeyCount>0</KeyCount></ListBucketResult>"
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def do_PUT(self):
        self.made.append(self.path.strip("/"))
        self.send_response(200)
        self.send_header("Content-Length", "0")
        self.end_headers()

    def log_message(self, *_):
        pass


def test_a_missing_bucket_is_made():
    server = HTTPServer(("127.0.0.1", 0), Buckets)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    root = S.resolve_root("minio", endpoint=f"http://127.0.0.1:{server.server_port}", access_key="a", secret_key="s", bucket_name="feeds", secure=False)
    assert S.make_bucket(root) and Buckets.made == ["feeds"] and not S.make_bucket(root) and Buckets.made == ["feeds"]
    assert not S.make_bucket(S.resolve_root("filesystem", base_directory="/tmp")) and S.arrow_path(f"{root.uri}/a/b c") == "feeds/a/b c" and S.arrow_path("file:///x/y") == "/x/y"
    server.shutdown()


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        conf = {}
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_root(Session)


def test_registered_types(spark, tmp_path):
    S.register_storage_type("Scratch", lambda where: S.Root(f"file://{where}"))
    try:
        S.create_storage_from_config(spark, "scratch", {"where": str(tmp_path)}).save_bytes(b"x", "f")
        assert (tmp_path / "f").read_bytes() == b"x"
    finally:
        del S.RESOLVERS["scratch"]


def test_landing(spark, store, tmp_path):
    df, at = spark.createDataFrame([(1, "x")], "fetchTime long, s string"), datetime(2024, 1, 2, 3, 4, 5)
    first, second = land(df, store, "p", "S", at), land(df, store, "p", "S", at)
    assert first == "p/S/individual/2024-01-02_03-04-05.parquet" and second.startswith("p/S/individual/2024-01-02_03-04-05~")
    meta = pq.ParquetFile(tmp_path / "a b" / first).metadata
    assert meta.num_rows == 1 and meta.row_group(0).column(0).compression == "SNAPPY"
    assert store.list_files("_staging", recursive=True) == []
    assert write_single(df.limit(0), store, "p/empty.parquet", "zstd") and pq.read_table(tmp_path / "a b/p/empty.parquet").num_rows == 0


@pytest.mark.parametrize("count", [0, 1, 2, 3])
def test_buffer_lands_each_file_when_full(spark, store, count):
    df, buffer = spark.createDataFrame([(1,)], "i int"), LandingBuffer(store, count)
    landed = [len(buffer.add(df, "p", "S", datetime(2024, 1, 1, 0, 0, i))) for i in range(4)]
    n = max(count, 1)
    assert landed == [n if (i + 1) % n == 0 else 0 for i in range(4)]
    assert len(store.list_files("p/S/individual")) == sum(landed)
    assert len(LandingBuffer(store, count).flush("p", "S")) == 4 - sum(landed)  # what is held outlives the buffer


def test_options():
    assert parquet_options("brotli")["compression"] == "zstd" and parquet_options("snappy")["parquet.dictionary.page.size"] == "5000"
    assert pa.Codec.is_available("zstd")
