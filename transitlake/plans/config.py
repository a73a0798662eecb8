"""Configuration of a lake: where files go, which feeds are fetched, how often, and how they are bucketed.  Read from TOML."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, replace
from pathlib import Path
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from ..sources.storage import RESOLVERS
from .schemas import SERVICES

REFRESH_SECONDS, FREQUENCY_MINUTES, CHECK_SECONDS, ACCUMULATE = 60, 60, 300, 0
FILENAME_FORMAT, TIME_FORMAT = "{group_time}_to_{next_period}.parquet", "%H-%M-%S"


def _positive(name: str, value: int) -> None:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a positive whole number, not {value!r}")


@dataclass(frozen=True)
class StorageConfig:
    type: str
    params: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.type.lower() not in RESOLVERS:
            raise ValueError(f"no storage type {self.type!r}; there are {', '.join(sorted(RESOLVERS))}")


@dataclass(frozen=True)
class ApiConfig:
    url: str
    services: tuple[str, ...]
    refresh_seconds: int = REFRESH_SECONDS
    frequency_minutes: int = FREQUENCY_MINUTES
    check_interval_seconds: int = CHECK_SECONDS
    accumulate_count: int = ACCUMULATE

    def __post_init__(self) -> None:
        object.__setattr__(self, "services", tuple(self.services))
        if unknown := [s for s in self.services if s not in SERVICES]:
            raise ValueError(f"no service {unknown[0]!r}; there are {', '.join(SERVICES)}")
        for name in ("refresh_seconds", "frequency_minutes", "check_interval_seconds"):
            _positive(name, getattr(self, name))
        if self.accumulate_count < 0:
            raise ValueError("accumulate_count must not be negative")


@dataclass(frozen=True)
class ProviderConfig:
    name: str
    apis: tuple[ApiConfig, ...]
    timezone: str = "UTC"
    frequency_minutes: int | None = None
    check_interval_seconds: int | None = None
    storage: StorageConfig | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "apis", tuple(self.apis))
        try:
            ZoneInfo(self.timezone)
        except (ZoneInfoNotFoundError, ValueError, IsADirectoryError):
            raise ValueError(f"no time zone {self.timezone!r}") from None
        for name in ("frequency_minutes", "check_interval_seconds"):
            if getattr(self, name) is not None:
                _positive(name, getattr(self, name))


@dataclass(frozen=True)
class OutputConfig:
    filename_format: str = FILENAME_FORMAT
    time_format: str = TIME_FORMAT


@dataclass(frozen=True)
class LakeConfig:
    storage: StorageConfig
    providers: tuple[ProviderConfig, ...]
    output: OutputConfig = OutputConfig()

    def __post_init__(self) -> None:
        object.__setattr__(self, "providers", tuple(self.providers))
        names = [p.name for p in self.providers]
        if len(set(names)) < len(names):
            raise ValueError("provider names must differ")

    def provider(self, name: str) -> ProviderConfig:
        for p in self.providers:
            if p.name == name:
                return p
        raise ValueError(f"no provider {name!r}")

    def provider_storage(self, name: str) -> StorageConfig:
        """The provider's own storage, or else the global one."""
        return self.provider(name).storage or self.storage


def effective_api(provider: ProviderConfig, api: ApiConfig) -> ApiConfig:
    """The API with the provider's bucket size and check interval in place of values that are still the defaults."""
    changes = {}
    if api.frequency_minutes == FREQUENCY_MINUTES and provider.frequency_minutes is not None:
        changes["frequency_minutes"] = provider.frequency_minutes
    if api.check_interval_seconds == CHECK_SECONDS and provider.check_interval_seconds is not None:
        changes["check_interval_seconds"] = provider.check_interval_seconds
    return replace(api, **changes)


def _required(table: dict, key: str, where: str):
    if not table.get(key):
        raise ValueError(f"Missing required field: {where}.{key}")
    return table[key]


def _storage(table: dict, where: str) -> StorageConfig:
    return StorageConfig(_required(table, "type", where), table.get("params", {}))


def _api(table: dict, provider: str) -> ApiConfig:
    url = _required(table, "url", f"provider {provider}: apis")
    services = _required(table, "services", f"provider {provider}: apis")
    known = ("refresh_seconds", "frequency_minutes", "check_interval_seconds", "accumulate_count")
    return ApiConfig(url, tuple(services), **{k: table[k] for k in known if k in table})


def _provider(table: dict) -> ProviderConfig:
    name = _required(table, "name", "provider")
    apis = tuple(_api(a, name) for a in table.get("apis", []))
    if not apis:
        raise ValueError(f"No APIs defined for provider {name}")
    storage = _storage(table["storage"], f"provider {name}: storage") if "storage" in table else None
    return ProviderConfig(name, apis, table.get("timezone", "UTC"), table.get("frequency_minutes"), table.get("check_interval_seconds"), storage)


def config_from_dict(table: dict) -> LakeConfig:
    """A configuration from parsed TOML; what is missing or wrong raises ValueError."""
    storage = _storage(table.get("storage", {}), "storage")
    providers = tuple(_provider(p) for p in table.get("providers", []))
    if not providers:
        raise ValueError("No providers defined")
    out = table.get("output", {})
    return LakeConfig(storage, providers, OutputConfig(out.get("filename_format", FILENAME_FORMAT), out.get("time_format", TIME_FORMAT)))


def load_config_from_toml(path: str | Path) -> LakeConfig:
    """Reads a TOML file; a missing one raises FileNotFoundError."""
    with open(path, "rb") as f:
        return config_from_dict(tomllib.load(f))


def load_config_from_toml_file(path: str | Path) -> LakeConfig:
    """The same, but whatever goes wrong is a ValueError."""
    try:
        return load_config_from_toml(path)
    except Exception as e:
        raise ValueError(f"Error loading configuration: {e}") from e
