"""Configuration of one source: strict keys, checked values, the store's place from the environment."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields
from pathlib import Path

from .errors import ConfigError

STORE_VARIABLE = "ALLUVIUM_STORE"
# Fixed value: what a request says of itself where the configuration names no headers.
USER_AGENT = "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36"


@dataclass(frozen=True)
class Extract:
    source: str
    store: str
    scraper: str
    base_url: str
    partitions: int = 5
    timeout_seconds: float = 30.0
    headers: dict[str, str] = field(default_factory=lambda: {"User-Agent": USER_AGENT})
    follow_redirects: bool = True
    concurrency: int = 5
    allowed_domains: tuple[str, ...] = ()
    scrape_patterns: tuple[str, ...] = ()
    ignore_patterns: tuple[str, ...] = ()
    max_pages: int = -1
    request_delay: float = 0.0
    blocklist_tags: tuple[str, ...] = ()
    blocklist_attributes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Transform:
    source: str
    store: str
    parser: str
    partitions: int = 5


@dataclass(frozen=True)
class Load:
    source: str
    store: str
    builder: str
    partitions: int = 5


@dataclass(frozen=True)
class Config:
    name: str
    store: str
    log_level: str = "INFO"
    partitions: int = 5
    extract: Extract | None = None
    transform: Transform | None = None
    load: Load | None = None


_BLOCKS = {"extract": Extract, "transform": Transform, "load": Load}
_AT_LEAST = {"concurrency": 1, "partitions": 1, "max_pages": -1, "request_delay": 0, "timeout_seconds": 0}
_TUPLES = ("allowed_domains", "scrape_patterns", "ignore_patterns", "blocklist_tags", "blocklist_attributes")


def _made(kind: type, body: object, where: str):
    if not isinstance(body, dict):
        raise ConfigError(f"{where}: a mapping is required")
    known = {f.name: f for f in fields(kind)}
    if unknown := sorted(map(str, set(body) - set(known))):
        raise ConfigError(f"{where}: unknown keys {', '.join(unknown)}")
    values = dict(body)
    for name, least in _AT_LEAST.items():
        v = values.get(name)
        if name in values and (isinstance(v, bool) or not isinstance(v, (int, float)) or v < least):
            raise ConfigError(f"{where}.{name}: a number of at least {least} is required, not {v!r}")
    for name in _TUPLES:
        if name in values:
            if not isinstance(values[name], (list, tuple)) or not all(isinstance(x, str) for x in values[name]):
                raise ConfigError(f"{where}.{name}: a list of strings is required")
            values[name] = tuple(values[name])
            if name.endswith("_patterns"):
                for p in values[name]:
                    try:
                        re.compile(p)
                    except re.error as e:
                        raise ConfigError(f"{where}.{name}: {p!r}: {e}") from e
    try:
        return kind(**values)
    except TypeError as e:
        raise ConfigError(f"{where}: {e}") from e


def from_mapping(body: dict, store: str) -> Config:
    """Children take the name (as source), the store and the partitions of the parent unless they set their own."""
    if not isinstance(body, dict):
        raise ConfigError("the configuration must be a mapping")
    body = body | {"store": store}
    inherited = {"source": body.get("name"), "store": store} | ({"partitions": body["partitions"]} if "partitions" in body else {})
    children = {}
    for name, kind in _BLOCKS.items():
        if body.get(name) is not None:
            children[name] = _made(kind, inherited | body[name] if isinstance(body[name], dict) else body[name], name)
    return _made(Config, {k: v for k, v in body.items() if k not in _BLOCKS} | children, "configuration")


def store_path() -> str:
    store = os.environ.get(STORE_VARIABLE)
    if not store:
        raise ConfigError(f"{STORE_VARIABLE} is not set")
    return store


def load(path: str | Path) -> Config:
    store = store_path()
    try:
        import yaml
    except ImportError as e:
        raise ConfigError("reading a configuration file takes the yaml module") from e
    try:
        body = yaml.safe_load(Path(path).read_text())
    except FileNotFoundError as e:
        raise ConfigError(f"no configuration at {path}") from e
    except yaml.YAMLError as e:
        raise ConfigError(f"{path}: {e}") from e
    return from_mapping(body or {}, store)
