"""Run settings: from the environment or a .env file, with a whitelist on what reaches a filter."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

# Names and defaults of the settings.
REQUIRED = ("CLICKHOUSE_HOST", "CLICKHOUSE_DB", "QUERY_START_DATE", "QUERY_END_DATE")
DEFAULTS = {"CLICKHOUSE_PORT": "9000", "CLICKHOUSE_USER": "default", "CLICKHOUSE_PASSWORD": "", "QUERY_INSTRUMENT": "EURUSD", "QUERY_TIMEFRAME": "m1"}
PUNCTUATION = "-_ :"


def checked(value: str) -> str:
    """``value`` if all its characters are letters, digits or one of ``- _ space :``."""
    if bad := {c for c in value if not (c.isalnum() or c in PUNCTUATION)}:
        raise ValueError(f"characters not allowed in {value!r}: {sorted(bad)}")
    return value


def read_env_file(path: str | Path) -> dict[str, str]:
    """KEY=VALUE lines; blank lines and # comments are skipped, outer quotes removed."""
    out = {}
    for line in Path(path).read_text().splitlines():
        key, sep, value = line.strip().partition("=")
        if sep and not key.startswith("#"):
            out[key.removeprefix("export ").strip()] = value.strip().strip("\"'")
    return out


@dataclass(frozen=True)
class Config:
    host: str
    database: str
    start: str
    end: str
    port: int = 9000
    user: str = "default"
    password: str = ""
    instrument: str = "EURUSD"
    timeframe: str = "m1"

    def __post_init__(self) -> None:
        for value in (self.instrument, self.timeframe, self.start, self.end):
            checked(value)

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None, env_file: str | Path | None = None) -> Config:
        """Settings of the file, then of ``env`` (the process environment if none is given)."""
        env = dict(os.environ if env is None else env)
        if env_file is not None and Path(env_file).exists():
            env = read_env_file(env_file) | env
        if missing := [k for k in REQUIRED if k not in env]:
            raise KeyError(f"settings not given: {', '.join(missing)}")
        get = lambda k: env.get(k, DEFAULTS.get(k, ""))
        return cls(get("CLICKHOUSE_HOST"), get("CLICKHOUSE_DB"), get("QUERY_START_DATE"), get("QUERY_END_DATE"), int(get("CLICKHOUSE_PORT")), get("CLICKHOUSE_USER"), get("CLICKHOUSE_PASSWORD"), get("QUERY_INSTRUMENT"), get("QUERY_TIMEFRAME"))

    def jdbc_url(self) -> str:
        return f"jdbc:clickhouse://{self.host}:{self.port}/{self.database}"
