"""The running lake: fetch jobs that land feeds, and compaction jobs that close buckets."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from pathlib import Path
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from ..operators.compact import Compacted, compact
from ..operators.entities import service_counts, service_table
from ..sources import feed
from ..sources.sinks import LandingBuffer
from ..sources.storage import Storage, create_storage
from .config import LakeConfig, effective_api, load_config_from_toml
from .scheduler import Schedule, Scheduler

logger = logging.getLogger(__name__)


def default_session() -> SparkSession:
    """The session of a lake: UTC, adaptive plans, fair sharing between jobs."""
    return SparkSession.builder.appName("transitlake").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.scheduler.mode", "FAIR").getOrCreate()


def service_tables(snapshots: DataFrame, services: list[str], on_error: str = "raise") -> dict[str, DataFrame]:
    """The requested services that have rows in the snapshots, as tables. Nothing is cached; who reads several tables caches the snapshots."""
    entities = feed.decode(snapshots, services, on_error)
    there = {r["service"] for r in service_counts(entities).collect()}  # a row per service
    for service in services:
        if service not in there:
            logger.warning("no %s in the feed", service)
    return {s: service_table(entities, s) for s in services if s in there}


@contextmanager
def fetched_tables(spark: SparkSession, urls: list[tuple[str, str]], services: list[str], at: datetime | None = None) -> Iterator[dict[str, DataFrame]]:
    """One fetch of (provider, url) pairs, by a task each, as service tables, which last as long as the context.

    What cannot be fetched is logged, what cannot be decoded raises.
    """
    at = at or datetime.now(timezone.utc)
    snapshots = feed.http_snapshots(spark, urls, at.timestamp()).persist()
    try:
        for r in snapshots.where("error IS NOT NULL").select("url", "error").collect():  # a row per URL
            logger.error("%s: %s", r["url"], r["error"])
        yield service_tables(snapshots, services)
    finally:
        snapshots.unpersist()


def fetch_and_parse(spark: SparkSession, url: str, services: list[str], provider: str = "", at: datetime | None = None) -> dict[str, DataFrame]:
    """One fetch as service tables; if it or its decoding fails, that is logged and there are none. The tables hold the feed's bytes and need no release."""
    at = at or datetime.now(timezone.utc)
    try:
        body = feed.fetch(url)
        return service_tables(spark.createDataFrame([(provider, url, at, body)], feed.SNAPSHOT), services)
    except Exception:
        logger.exception("no tables from %s", url)
        return {}


class Lake:
    """Wires a configuration to storages, jobs and a scheduler."""

    def __init__(self, config: LakeConfig, spark: SparkSession | None = None, scheduler: Scheduler | None = None):
        self.config, self.spark = config, spark or default_session()
        self.storages: dict[str, Storage] = {"global": self._storage(config.storage)}
        self.storages |= {p.name: self._storage(p.storage) for p in config.providers if p.storage}
        self.scheduler = scheduler or Scheduler()

    def _storage(self, config) -> Storage:
        return create_storage(self.spark, config.type, **config.params)

    def storage(self, provider: str) -> Storage:
        return self.storages.get(provider, self.storages["global"])

    def fetch_once(self, provider: str, url: str, services: list[str], zone: str = "UTC", accumulate: int = 0) -> list[str]:
        """Fetches a feed and lands its tables, or holds them; the paths that landed. One instant names files and rows."""
        at = datetime.now(timezone.utc).replace(microsecond=0)
        buffer, out = LandingBuffer(self.storage(provider), accumulate), []
        try:
            with fetched_tables(self.spark, [(provider, url)], services, at) as tables:
                for service, table in tables.items():
                    out += buffer.add(table, provider, service, at.astimezone(ZoneInfo(zone)).replace(tzinfo=None))
        except Exception:
            logger.exception("no tables from %s", url)
        return out

    def compact_once(self, provider: str, services: list[str], minutes: int, zone: str = "UTC", **options) -> dict[str, list[Compacted]]:
        """Compacts closed buckets of each service; one that fails is logged and does not keep the others."""
        out = {}
        for service in services:
            try:
                out[service] = compact(self.storage(provider), provider, service, minutes, zone, filename_format=self.config.output.filename_format, time_format=self.config.output.time_format, **options)
            except Exception:
                logger.exception("%s/%s was not compacted", provider, service)
        return out

    def fetch_schedules(self) -> list[Schedule]:
        return [
            (a.refresh_seconds, self.fetch_once, f"Fetch - {p.name} - {a.url} - {', '.join(a.services)}", {"provider": p.name, "url": a.url, "services": list(a.services), "zone": p.timezone, "accumulate": a.accumulate_count})
            for p in self.config.providers
            for a in p.apis
        ]

    def compaction_schedules(self) -> list[Schedule]:
        return [
            (a.check_interval_seconds, self.compact_once, f"Compact - {p.name} - {', '.join(a.services)} - {a.frequency_minutes}m", {"provider": p.name, "services": list(a.services), "minutes": a.frequency_minutes, "zone": p.timezone})
            for p in self.config.providers
            for a in (effective_api(p, x) for x in p.apis)
        ]

    def start(self) -> None:
        """Runs until stopped."""
        self.scheduler.add_schedules(self.fetch_schedules())
        self.scheduler.add_schedules(self.compaction_schedules())
        logger.info("the lake runs; Ctrl+C stops it")
        self.scheduler.start()

    def stop(self) -> None:
        self.scheduler.stop()


def run_pipeline(config: LakeConfig, spark: SparkSession | None = None) -> None:
    """Runs a configuration until stopped."""
    lake = Lake(config, spark)
    try:
        lake.start()
    finally:
        lake.stop()


def run_pipeline_from_toml(path: str | Path) -> None:
    """Loads a TOML file and runs it until stopped."""
    run_pipeline(load_config_from_toml(path))


def wait_until(condition, seconds: float, pause: float = 0.1) -> bool:
    """Whether ``condition()`` came true within so many seconds."""
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        if condition():
            return True
        time.sleep(pause)
    return bool(condition())
