"""Settings of the capture jobs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Name fragments whose fields are redacted by default.
DEFAULT_FRAGMENTS = ("password", "passwd", "secret", "token", "api_key", "auth", "credential")


def _clamp(value: float, low: float, high: float) -> float:
    return max(low, min(high, float(value)))


@dataclass(frozen=True)
class CaptureConfig:
    """Settings of the error job; out-of-range numbers are pulled to the nearest allowed value."""

    dsn: str | None = None
    api_key: str | None = None
    enabled: bool = True
    environment: str = "production"
    release: str | None = None
    sample_rate: float = 1.0
    sample_seed: str = "0"
    max_breadcrumbs: int = 50
    max_buffered_events: int = 100
    fragments: tuple[str, ...] = DEFAULT_FRAGMENTS
    max_scan_bytes: int | None = None
    fingerprint_message: bool = False
    session_hash_salt: str | None = None
    before_send: Callable[[DataFrame], DataFrame] | None = None
    events_per_second: str = "10"
    burst: int = 20

    def __post_init__(self):
        object.__setattr__(self, "sample_rate", _clamp(self.sample_rate, 0.0, 1.0))
        object.__setattr__(self, "max_breadcrumbs", max(1, int(self.max_breadcrumbs)))
        object.__setattr__(self, "max_buffered_events", max(1, int(self.max_buffered_events)))

    @property
    def literals(self) -> tuple[str, ...]:
        return tuple(v for v in (self.dsn, self.api_key) if v)

    @property
    def salt(self) -> str:
        """The key for session hashes: the given one, else a digest of the DSN."""
        if self.session_hash_salt:
            return self.session_hash_salt
        if not self.dsn:
            raise ValueError("session hashes need a salt or a DSN")
        import xxhash

        return xxhash.xxh128_hexdigest(self.dsn.strip(" \t\n\r\0\x0b"))


@dataclass(frozen=True)
class LogConfig:
    """Settings of the log job."""

    endpoint: str | None = None
    token: str | None = None
    app_name: str | None = None
    environment: str | None = None
    max_buffered_logs: int = 100
    batch_size: int = 1000
    fragments: tuple[str, ...] = DEFAULT_FRAGMENTS
    literals: tuple[str, ...] = field(default=())
    max_scan_bytes: int | None = None
    safe_interpolation: bool = False

    def __post_init__(self):
        object.__setattr__(self, "max_buffered_logs", max(1, int(self.max_buffered_logs)))
