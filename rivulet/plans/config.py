"""Options of sources and sinks."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

# Defaults of the options.
FETCH_SIZE = 10_000
BATCH_SIZE = 10_000
BATCH_DELAY_MS = 1_000

DSN = re.compile(r"^(?:(?P<user>[^:@/]*)(?::(?P<password>.*))?@)?(?:(?P<net>[a-z0-9]+)(?:\((?P<address>[^)]*)\))?)?/(?P<database>[^?]*)(?:\?(?P<params>.*))?$", re.S)


class ConfigError(ValueError):
    """An option that is missing or wrong."""


@dataclass(frozen=True)
class Dsn:
    """A data source name ``user:password@net(address)/database?params``."""

    user: str
    password: str
    address: str
    database: str
    params: Mapping[str, str]

    @classmethod
    def parse(cls, text: str) -> Dsn:
        m = DSN.match(text or "")
        if not m:
            raise ConfigError("dsn is not of the form user:password@net(address)/database")
        if not m["database"]:
            raise ConfigError("dsn names no database")
        params = dict(p.partition("=")[::2] for p in (m["params"] or "").split("&") if p)
        params["parseTime"] = "true"  # times always come as times
        address = m["address"] or "127.0.0.1:3306"
        return cls(m["user"] or "", m["password"] or "", address if ":" in address else f"{address}:3306", m["database"], params)

    def jdbc_url(self) -> str:
        return f"jdbc:mysql://{self.address}/{self.database}"


@dataclass(frozen=True)
class SourceConfig:
    dsn: str
    tables: tuple[str, ...]
    sorting: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = FETCH_SIZE
    snapshot: bool = True
    unsafe: bool = False
    disable_logs: bool = False
    batch_size: int = BATCH_SIZE
    batch_delay_ms: int = BATCH_DELAY_MS

    def __post_init__(self) -> None:
        if not [t for t in self.tables if t.strip()]:
            raise ConfigError("tables names no table")
        if self.fetch_size < 0 or self.batch_size < 0 or self.batch_delay_ms < 0:
            raise ConfigError("sizes and delays are not negative")
        Dsn.parse(self.dsn)

    @property
    def database(self) -> str:
        return Dsn.parse(self.dsn).database

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> SourceConfig:
        """From flat options such as ``snapshot.fetchSize`` and ``tableConfig.users.sortingColumn``."""
        known = {"dsn", "tables", "cdc.disableLogs", "snapshot.enabled", "snapshot.fetchSize", "snapshot.unsafe", "sdk.batch.size", "sdk.batch.delay.ms"}
        sorting = {}
        for k, v in options.items():
            if m := re.fullmatch(r"tableConfig\.(.+)\.sortingColumn", k):
                if v.strip():
                    sorting[m[1]] = v.strip()
            elif k not in known:
                raise ConfigError(f"unknown option {k}")
        if "dsn" not in options or "tables" not in options:
            raise ConfigError("dsn and tables are required")
        flag = lambda k, d: options.get(k, d).strip().lower() in ("true", "1")
        return cls(
            options["dsn"], tuple(t.strip() for t in options["tables"].split(",")), sorting,
            int(options.get("snapshot.fetchSize", FETCH_SIZE)) or FETCH_SIZE, flag("snapshot.enabled", "true"), flag("snapshot.unsafe", "false"), flag("cdc.disableLogs", "false"),
            int(options.get("sdk.batch.size", BATCH_SIZE)), int(options.get("sdk.batch.delay.ms", BATCH_DELAY_MS)),
        )


@dataclass(frozen=True)
class SinkConfig:
    dsn: str
    batch_size: int = 0
    batch_delay_ms: int = 0
    rate_per_second: float = 0.0
    burst: int = 0
    keys: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        Dsn.parse(self.dsn)
        if self.batch_size < 0 or self.batch_delay_ms < 0 or self.rate_per_second < 0 or self.burst < 0:
            raise ConfigError("sizes, delays and rates are not negative")
