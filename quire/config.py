"""Settings of a run. The pull date is never read from a clock, so runs repeat exactly: it is the caller's or the
environment's, else that of the fixtures."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    pull_date: str = "2026-07-23"
    data_dir: str = "data"
    mailto: str = ""
    only: tuple[str, ...] = ()
    allow_shrink: bool = False
    recent_days: int = 90
    recent_limit: int = 1500
    affiliation_limit: int = 3000
    author_limit: int = 5000
    abstract_limit: int = 4000
    seed_per_source: int = 3
    influx: int = 250
    min_age_days: int = 2
    search_version: int = 3
    search_first_year: int = 1991
    search_cap: int | None = 6000  # calls of a run; None: as many as are due
    citation_cap: int | None = 500_000
    citation_seconds: float = 2700.0
    search_seconds: float = 1500.0
    citation_flush: int = 100  # batches of 50 keys after which counts are saved
    search_flush: int = 200  # title searches after which links are saved
    mock: bool = False  # a build from fixtures alone: the editors that other builds share are left out

    @property
    def pull_year(self) -> int:
        return int(self.pull_date[:4])

    @classmethod
    def from_env(cls, env: dict[str, str]) -> Config:
        """From QUIRE_* variables: PULL_DATE, DATA_DIR, MAILTO, ONLY (comma list), ALLOW_SHRINK, MOCK; CITATION_CAP,
        CITATION_MS, MIN_AGE_DAYS, SEARCH_CAP, SEARCH_MS (caps and budgets of the refresh jobs)."""
        given: dict = {k: env[f"QUIRE_{k.upper()}"] for k in ("pull_date", "data_dir", "mailto") if env.get(f"QUIRE_{k.upper()}")}
        given |= {k: int(env[f"QUIRE_{k.upper()}"]) for k in ("citation_cap", "min_age_days", "search_cap") if env.get(f"QUIRE_{k.upper()}")}
        given |= {f"{k}_seconds": int(env[f"QUIRE_{k.upper()}_MS"]) / 1000 for k in ("citation", "search") if env.get(f"QUIRE_{k.upper()}_MS")}
        only = tuple(x.strip() for x in env.get("QUIRE_ONLY", "").split(",") if x.strip())
        return cls(**given, only=only, allow_shrink=env.get("QUIRE_ALLOW_SHRINK") == "1", mock=env.get("QUIRE_MOCK") == "1")
