"""The configuration of a run: nested, strict (unknown keys and bad values are refused), with defaults."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import typing
from dataclasses import dataclass, field
from pathlib import Path

from ..sources import providers  # noqa: F401  adds its providers
from ..sources.formats import FORMATS
from ..sources.landing import PROVIDERS


def _check(cond: bool, message: str) -> None:
    if not cond:
        raise ValueError(message)


@dataclass(frozen=True)
class SourceConfig:
    name: str
    kind: str
    provider: str
    options: dict = field(default_factory=dict)
    enabled: bool = True
    cache_ttl_s: float | None = None

    def __post_init__(self):
        _check(self.kind in FORMATS and self.provider in PROVIDERS and bool(self.name.strip()), f"unknown source: {self.name} ({self.kind}, {self.provider})")


@dataclass(frozen=True)
class ExtractionConfig:
    """Fetching of documents; delays until the next try are in hours, by category."""

    enabled: bool = False
    workers: int = 32
    delay_s: float = 0.5
    timeout_s: float = 15
    retries: int = 2
    transient_hours: float = 1
    blocked_hours: float = 24 * 30
    dns_hours: float = 24 * 7
    content_hours: float = 24 * 30
    header_profiles: dict = field(default_factory=dict)

    def __post_init__(self):
        _check(self.workers > 0 and self.retries >= 0 and min(self.delay_s, self.transient_hours, self.blocked_hours, self.dns_hours, self.content_hours) >= 0 and self.timeout_s > 0, "extraction: workers and timeout_s are positive, the rest isn't negative")

    def delays(self) -> dict[str, float]:
        return {"transient": self.transient_hours, "access_blocked": self.blocked_hours, "dns": self.dns_hours, "unextractable_content": self.content_hours}


@dataclass(frozen=True)
class LinkerConfig:
    enabled: bool = False
    url: str = ""
    model: str = "en"
    confidence: float = 0.5
    support: int = 20
    timeout_s: float = 20
    workers: int = 8

    def __post_init__(self):
        _check(self.workers > 0 and 0 <= self.confidence <= 1, "linker: workers is positive and confidence lies in 0 to 1")


@dataclass(frozen=True)
class PropertiesConfig:
    enabled: bool = False
    endpoint: str = ""
    properties: tuple[str, ...] = ()
    timeout_s: float = 20
    delay_s: float = 0.1
    retries: int = 2
    batch: int = 50

    def __post_init__(self):
        _check(self.batch > 0 and self.retries >= 0, "properties: batch is positive")


@dataclass(frozen=True)
class FactorsConfig:
    enabled: bool = False
    versions: dict = field(default_factory=dict)
    batch: int = 32
    max_length: int = 128
    timeout_s: float = 60
    delay_s: float = 0.1
    workers: int = 1

    def __post_init__(self):
        _check(self.batch > 0 and self.workers > 0, "factors: batch and workers are positive")


@dataclass(frozen=True)
class EnrichmentConfig:
    linker: LinkerConfig = field(default_factory=LinkerConfig)
    properties: PropertiesConfig = field(default_factory=PropertiesConfig)
    factors: FactorsConfig = field(default_factory=FactorsConfig)

    def __post_init__(self):
        _check(self.linker.enabled or not self.properties.enabled, "properties need the linker")


@dataclass(frozen=True)
class OutputConfig:
    path: str = "{ROOT}/snapshots/{DATETIME}"
    format: str = "nt"
    one_file: bool = False

    def __post_init__(self):
        _check(self.format == "nt", "runs publish N-Triples")


@dataclass(frozen=True)
class LoggingConfig:
    level: str = "INFO"
    file: str | None = None
    max_size: str = "10MB"
    backups: int = 5

    def __post_init__(self):
        _check(self.level in ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"), f"no level {self.level}")


@dataclass(frozen=True)
class RunConfig:
    """Where a run keeps its tables and snapshots, its sources and stages."""

    root: str
    sources: tuple[SourceConfig, ...]
    cache_ttl_s: float = 24 * 3600
    keep_snapshots: int = 3
    catalog: str | None = None
    vocabularies: dict = field(default_factory=dict)
    progress_s: float = 10.0
    extraction: ExtractionConfig = field(default_factory=ExtractionConfig)
    enrichment: EnrichmentConfig = field(default_factory=EnrichmentConfig)
    output: OutputConfig = field(default_factory=OutputConfig)
    logging: LoggingConfig = field(default_factory=LoggingConfig)

    @staticmethod
    def load(path: str) -> RunConfig:
        """From a JSON file, or YAML where that library is there."""
        text = Path(path).read_text()
        if path.endswith((".yaml", ".yml")):
            import yaml

            raw = yaml.safe_load(text)
        else:
            raw = json.loads(text)
        config = build(RunConfig, raw)
        _check(bool(config.sources) and len({s.name for s in config.sources}) == len(config.sources) and config.keep_snapshots >= 1, "sources need distinct names, and at least one snapshot stays")
        return config

    def hash(self) -> str:
        """What decides a run's results: all but where it logs."""
        return hashlib.sha256(json.dumps(dataclasses.asdict(dataclasses.replace(self, logging=LoggingConfig())), sort_keys=True, default=str).encode()).hexdigest()


def build(kind: type, raw: dict):
    """A configuration of nested dictionaries; unknown keys, missing keys and values of another type are refused."""
    _check(isinstance(raw, dict), f"{kind.__name__} needs an object")
    hints = typing.get_type_hints(kind)
    unknown = set(raw) - set(hints)
    _check(not unknown, f"unknown keys: {sorted(unknown)}")
    missing = [f.name for f in dataclasses.fields(kind) if f.name not in raw and f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING]
    _check(not missing, f"missing keys: {missing}")
    return kind(**{k: _value(hints[k], v, k) for k, v in raw.items()})


def _value(hint, value, name: str):
    if dataclasses.is_dataclass(hint):
        return build(hint, value)
    origin = typing.get_origin(hint)
    if origin is tuple:
        _check(isinstance(value, list | tuple), f"{name} needs a list")
        return tuple(_value(typing.get_args(hint)[0], v, name) for v in value)
    kinds = typing.get_args(hint) if origin is not None and origin is not dict else (origin or hint,)
    fits = any((k is type(None) and value is None) or (k is float and isinstance(value, int | float) and not isinstance(value, bool)) or (k is int and isinstance(value, int) and not isinstance(value, bool)) or (k in (str, bool, dict) and isinstance(value, k)) for k in kinds)
    _check(fits, f"{name} is of the wrong type: {value!r}")
    return value
