"""Settings of the engine; all of them are parameters of the operators that use them."""

from __future__ import annotations

import dataclasses
import os


def env_number(name: str, default: float, kind: type = int) -> float:
    """A number from the environment; the default where it is unset or no number."""
    try:
        return kind(os.environ.get(name, default))
    except ValueError:
        return default


@dataclasses.dataclass(frozen=True)
class Settings:
    platform_threshold: int = 4
    country_threshold: int = 4
    prefilter_threshold: int = 2
    max_pages: int = 5
    max_attempts: int = 3
    cache_ttl_hours: float = 168.0
    stale_minutes: int = 60
    batch_limit: int = 100
    max_response_bytes: int = 5_000_000

    def with_overrides(self, **changes) -> Settings:
        return dataclasses.replace(self, **changes)

    @classmethod
    def from_env(cls, prefix: str = "LANTERNFLOW_") -> Settings:
        return cls(**{f.name: env_number(prefix + f.name.upper(), f.default, type(f.default)) for f in dataclasses.fields(cls)})
