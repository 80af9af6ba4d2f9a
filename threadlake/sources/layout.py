"""Where tables live."""

from __future__ import annotations

from dataclasses import dataclass

LAYERS = ("raw", "processed", "output", "reports")
READABLE_LAYERS = ("raw", "processed", "output")
FORMATS = ("json", "parquet", "csv")


@dataclass(frozen=True)
class Lake:
    """A root folder with ``{layer}/{entity}/ingestion_date=YYYY-MM-DD/`` below it."""

    root: str

    def table(self, layer: str, entity: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{entity}"

    @property
    def manifest(self) -> str:
        return f"{self.root.rstrip('/')}/metadata/manifest"

    @property
    def tracking(self) -> str:
        return f"{self.root.rstrip('/')}/metadata/tracking"

    @property
    def tracking_log(self) -> str:
        return f"{self.root.rstrip('/')}/metadata/tracking_log"

    @property
    def observed(self) -> str:
        return f"{self.root.rstrip('/')}/metadata/observed"

    @property
    def observed_log(self) -> str:
        return f"{self.root.rstrip('/')}/metadata/observed_log"

    def quarantine(self, entity: str) -> str:
        return f"{self.root.rstrip('/')}/metadata/quarantine/{entity}"


def require(value: str, allowed: tuple[str, ...], what: str) -> None:
    if value not in allowed:
        raise ValueError(f"{what} {value!r} is not one of {', '.join(allowed)}")
