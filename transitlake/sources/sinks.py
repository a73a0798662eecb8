"""Landing of service tables: one Parquet file per provider, service and fetch; and the buffer that lands in batches."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime

from pyspark.sql import DataFrame

from ..functions.timebucket import STAMP_PYTHON
from .storage import Storage

logger = logging.getLogger(__name__)


def parquet_options(compression: str = "zstd") -> dict[str, str]:
    """Writer options of all files here. Brotli needs a codec that Spark does not bring; zstd takes its place."""
    if compression == "brotli":
        logger.warning("no brotli codec: writing zstd")
        compression = "zstd"
    return {"compression": compression, "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": "5000"}


def write_single(df: DataFrame, storage: Storage, path: str, compression: str, replace: bool = True) -> bool:
    """``df`` as one file at ``path``: written aside, then moved into place. An empty table is a file with a schema."""
    aside = f"_staging/{uuid.uuid4().hex}"
    df.coalesce(1).write.options(**parquet_options(compression)).parquet(storage.uri(aside))
    try:
        parts = storage.list_files(aside, "part-*.parquet")
        if not parts:
            raise OSError(f"nothing was written for {path}")
        return storage.rename_file(parts[0], path, replace=replace)
    finally:
        storage.delete_directory(aside)


def landing_name(local: datetime) -> str:
    return f"{local.strftime(STAMP_PYTHON)}.parquet"


def land(df: DataFrame, storage: Storage, provider: str, service: str, local: datetime, directory: str = "individual") -> str:
    """Lands a service table; a second table of the same second gets a name of its own, which reads as the same time."""
    path = f"{provider}/{service}/{directory}/{landing_name(local)}"
    if not write_single(df, storage, path, "snappy", replace=False):
        path = f"{path.removesuffix('.parquet')}~{uuid.uuid4().hex[:8]}.parquet"
        write_single(df, storage, path, "snappy", replace=False)
    return path


class LandingBuffer:
    """Holds landed files back until there are ``count`` of them for a provider and service, then lands each, unmerged.

    Held files lie in the store beside the landing directory, and so outlive the process; 0 writes through.
    """

    HELD = "_held"

    def __init__(self, storage: Storage, count: int = 0):
        self.storage, self.count = storage, count

    def add(self, df: DataFrame, provider: str, service: str, local: datetime) -> list[str]:
        """The paths that landed now: none while the buffer fills."""
        if self.count <= 0:
            return [land(df, self.storage, provider, service, local)]
        land(df, self.storage, provider, service, local, self.HELD)
        held = self.storage.list_files(f"{provider}/{service}/{self.HELD}", "*.parquet")
        return self.flush(provider, service) if len(held) >= self.count else []

    def flush(self, provider: str, service: str) -> list[str]:
        """Lands all that is held."""
        out = []
        for old in self.storage.list_files(f"{provider}/{service}/{self.HELD}", "*.parquet"):
            new = old.replace(f"/{self.HELD}/", "/individual/")
            if not self.storage.rename_file(old, new):
                new = f"{new.removesuffix('.parquet').split('~')[0]}~{uuid.uuid4().hex[:8]}.parquet"
                self.storage.rename_file(old, new)
            out.append(new)
        return out
