"""Job configuration, read from the environment or given in code."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# Transport modes, in the order their static directories are read.
MODES = ("bus", "metro", "tram")

_TRUE = {"1", "true", "yes", "on"}
_FALSE = {"", "0", "false", "no", "off"}


def parse_flag(text: str | None) -> bool:
    """Boolean from configuration text; unset means off, anything unknown is an error."""
    word = (text or "").strip().lower()
    if word in _TRUE:
        return True
    if word in _FALSE:
        return False
    raise ValueError(f"not a boolean: {text!r}")


@dataclass(frozen=True)
class JobConfig:
    """Settings shared by the streaming jobs.

    ``lake_path`` holds the silver tables, ``live_path`` the live views and ``checkpoint_path`` the stream
    checkpoints; each job adds its own table name below them. The schedule comes from ``static_path``, a directory per
    mode, or from ``snapshot_path``, where the ``static`` command keeps dated snapshots. An enabled sink needs the
    paths it uses: there are no defaults, which would lie on one machine. ``keyed_live_state`` keeps the live view in the
    stream's own state: a batch then costs its own trips and not all live ones. ``schema_path`` is a folder with a message
    schema for each topic, ``{topic}.json``, in place of the declared ones.
    """

    kafka_bootstrap_servers: str = "kafka:9092"
    static_path: str | None = None
    snapshot_path: str | None = None
    timezone: str = "Australia/Melbourne"
    enable_live_sink: bool = False
    enable_silver_sink: bool = False
    lake_path: str | None = None
    live_path: str | None = None
    checkpoint_path: str | None = None
    table_format: str = "parquet"
    silver_trigger: str = "1 minute"
    live_ttl_seconds: int = 120
    keyed_live_state: bool = False
    schema_path: str | None = None

    def __post_init__(self):
        needed = {"lake_path": self.enable_silver_sink, "live_path": self.enable_live_sink}
        needed["checkpoint_path"] = self.enable_silver_sink or self.enable_live_sink
        missing = [name for name, used in needed.items() if used and not getattr(self, name)]
        if needed["checkpoint_path"] and not (self.static_path or self.snapshot_path):
            missing.append("static_path or snapshot_path")
        if missing:
            raise ValueError(f"an enabled sink needs {', '.join(missing)}")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JobConfig:
        env = os.environ if env is None else env
        # Names of the settings.
        texts = {
            "kafka_bootstrap_servers": "KAFKA_BOOTSTRAP_SERVERS",
            "static_path": "STATIC_DATA_PATH",
            "snapshot_path": "STATIC_SNAPSHOT_PATH",
            "timezone": "APP_TIMEZONE",
            "lake_path": "SILVER_PATH",
            "live_path": "LIVE_PATH",
            "checkpoint_path": "CHECKPOINT_PATH",
            "table_format": "TABLE_FORMAT",
            "schema_path": "MESSAGE_SCHEMA_PATH",
        }
        given = {field: env[name] for field, name in texts.items() if env.get(name)}
        return cls(
            enable_live_sink=parse_flag(env.get("ENABLE_LIVE_SINK")),
            enable_silver_sink=parse_flag(env.get("ENABLE_SILVER_SINK")),
            keyed_live_state=parse_flag(env.get("KEYED_LIVE_STATE")),
            **given,
        )

    def static_paths(self, table: str) -> list[str]:
        """One directory per mode holding the given static table."""
        return [f"{self.static_path}/{mode}/{table}" for mode in MODES]

    def silver_table(self, topic: str) -> str:
        return f"{self.lake_path}/{topic}"

    def live_table(self, topic: str) -> str:
        return f"{self.live_path}/{topic}"

    def checkpoint(self, topic: str, sink: str) -> str:
        return f"{self.checkpoint_path}/{topic}/{sink}"
