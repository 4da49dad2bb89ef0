"""Job settings: a settings file over defaults, frozen per job."""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass, field


def _read_properties(path: str) -> dict[str, str]:
    """Java-style properties: ``key=value`` or ``key:value``, ``#``/``!`` comments."""
    out: dict[str, str] = {}
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            line = line.strip()
            if not line or line[0] in "#!":
                continue
            cut = [i for i in (line.find("="), line.find(":")) if i >= 0]
            if not cut:
                out[line] = ""
                continue
            i = min(cut)
            out[line[:i].strip()] = line[i + 1:].strip()
    return out


def _settings(path: str | None, keys: dict) -> dict:
    """The fields that a settings file sets, by a table key -> (field, parser)."""
    values: dict = {}
    if path and os.path.exists(path):
        for key, text in _read_properties(path).items():
            if key in keys:
                name, parse = keys[key]
                try:
                    values[name] = parse(text)
                except ValueError:
                    continue
    return values


def _as_bool(text: str) -> bool:
    # Same rule as Java's Boolean.parseBoolean: only "true", any case.
    return text.strip().lower() == "true"


@dataclass(frozen=True)
class ClickOptions:
    """Settings of the click-counting job (defaults are the job's own)."""

    checkpoint_dir: str | None = None
    window_size_mins: int = 10
    window_slide_secs: int = 60
    checkpoint_timeout_ms: int = 150000
    console_output: bool = True
    console_output_count_threshold: int = 5
    ten_or_more_threshold: int = 6
    nine_or_less_threshold: int = 9
    watermark_delay: str = "1 minute"
    trigger_interval: str = "15 seconds"

    # settings-file key -> (field, parser)
    _KEYS = {
        "CheckpointDir": ("checkpoint_dir", str),
        "WindowSizeMins": ("window_size_mins", int),
        "WindowSlideSecs": ("window_slide_secs", int),
        "CheckpointTimeout": ("checkpoint_timeout_ms", int),
        "ConsoleOutput": ("console_output", _as_bool),
        "ConsoleOutputCountThreshold": ("console_output_count_threshold", int),
        "TenOrMoreThreshold": ("ten_or_more_threshold", int),
        "NineOrLessThreshold": ("nine_or_less_threshold", int),
    }

    def __post_init__(self):
        if self.window_size_mins <= 0 or self.window_slide_secs <= 0:
            raise ValueError("window size and slide must be positive")
        if self.window_slide_secs > self.window_size_mins * 60:
            raise ValueError(
                f"window slide ({self.window_slide_secs} s) must not exceed the window "
                f"size ({self.window_size_mins} min): Spark refuses such windows")

    @property
    def window_duration(self) -> str:
        return f"{self.window_size_mins} minutes"

    @property
    def slide_duration(self) -> str:
        return f"{self.window_slide_secs} seconds"

    @property
    def tumbling(self) -> bool:
        return self.window_slide_secs == self.window_size_mins * 60

    @classmethod
    def from_properties(cls, path: str | None, **overrides) -> "ClickOptions":
        """Read a settings file; a missing file or key, or a bad number, keeps the default."""
        return cls(**{**_settings(path, cls._KEYS), **overrides})

    def replace(self, **changes) -> "ClickOptions":
        return dataclasses.replace(self, **changes)


# The settings files of the reference job (production, test).
# Their CheckpointDir line (a machine-local folder) is left out: checkpoints go
# to the folder the cluster names in spark.checkpoint.dir or to an explicit
# job argument.
PRODUCTION_PROPERTIES = """\
WindowSizeMins:10
WindowSlideSecs:60
CheckpointTimeout:150000
ConsoleOutput:False
ConsoleOutputCountThreshold:1
TenOrMoreThreshold:10
NineOrLessThreshold:9
"""
TEST_PROPERTIES = """\
WindowSizeMins:10
WindowSlideSecs:600
CheckpointTimeout:150000
ConsoleOutput:True
ConsoleOutputCountThreshold:0
TenOrMoreThreshold:10
NineOrLessThreshold:9
"""


def _from_text(text: str, **overrides) -> ClickOptions:
    values: dict = {}
    for line in text.splitlines():
        key, _, val = line.partition(":")
        if key in ClickOptions._KEYS:
            name, parse = ClickOptions._KEYS[key]
            values[name] = parse(val)
    values.update(overrides)
    return ClickOptions(**values)


PRODUCTION = _from_text(PRODUCTION_PROPERTIES)
TEST = _from_text(TEST_PROPERTIES)
# The driver tables are too sparse for 10-minute windows (at most 3 clicks per
# account), so the registered queries count over 7 days sliding by 1 day with
# the production thresholds.
DRIVER_TABLES = PRODUCTION.replace(window_size_mins=7 * 24 * 60, window_slide_secs=86400)


@dataclass(frozen=True)
class TelemetryOptions:
    """Settings of the telemetry jobs."""

    target_ids: tuple[str, ...] = ("ANTONIO_GIOVINAZZI",)
    # Parquet table (session_id, target_id); if set it replaces target_ids
    targets_path: str | None = None
    topic: str = "f1-telemetry-drivers"
    bootstrap_servers: str | None = None
    starting_offsets: str = "earliest"
    # rows that a micro-batch may take from the topic: bounds what one key's task holds
    max_offsets_per_trigger: int | None = 1_000_000
    # drop a race's state when its events are older than the watermark by this
    idle_timeout: str | None = None
    checkpoint_dir: str | None = None
    kafka_options: dict = field(default_factory=dict)

    # settings-file key -> (field, parser)
    _KEYS = {
        "KafkaPort": ("bootstrap_servers", lambda port: f"localhost:{int(port)}"),
        "startFromLatest": ("starting_offsets", lambda text: "latest" if _as_bool(text) else "earliest"),
        "DriverName": ("target_ids", lambda name: (name,)),
        "CheckpointDir": ("checkpoint_dir", str),
    }

    @classmethod
    def from_properties(cls, path: str | None, **overrides) -> "TelemetryOptions":
        """Read a settings file; a missing file or key, or a bad number, keeps the default."""
        return cls(**{**_settings(path, cls._KEYS), **overrides})

    def targets(self, spark):
        """The tracked ids, or the targets table."""
        return spark.read.parquet(self.targets_path) if self.targets_path else list(self.target_ids)
