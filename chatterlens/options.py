"""Job options with their bounds."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from chatterlens.operators.capture import normalise_search_tags

# Fixed value: the default search hashtags.
DEFAULT_HASHTAGS = ("#nifty50", "#sensex", "#banknifty", "#intraday")


@dataclass(frozen=True)
class JobOptions:
    """What a run reads, keeps and writes. ``as_of`` is the run's "now"."""

    output_dir: str
    as_of: datetime
    cutoff_hours: int
    search_hashtags: tuple[str, ...] = field(default=DEFAULT_HASHTAGS)
    max_posts: int | None = None  # None: all
    compression: str = "snappy"
    seed: int = 0
    max_features: int = 50
    ngram_range: tuple[int, int] = (1, 2)
    top_n: int = 10
    buy_threshold: float = 0.05
    sell_threshold: float = -0.05

    def __post_init__(self) -> None:
        for name in ("max_posts", "cutoff_hours", "max_features", "top_n"):
            if getattr(self, name) is not None and getattr(self, name) <= 0:
                raise ValueError(f"{name} must be > 0, got {getattr(self, name)}")
        object.__setattr__(self, "search_hashtags", tuple(normalise_search_tags(self.search_hashtags)))
        object.__setattr__(self, "output_dir", str(self.output_dir).rstrip("/"))

    @property
    def raw_dir(self) -> str:
        return f"{self.output_dir}/raw"

    @property
    def processed_dir(self) -> str:
        return f"{self.output_dir}/processed"

    @classmethod
    def from_env(cls, env: Mapping[str, str], as_of: datetime, **overrides) -> JobOptions:
        """Options from environment variables; ``overrides`` win. CUTOFF_HOURS has no default here."""
        values: dict = {"as_of": as_of}
        if env.get("SEARCH_HASHTAGS"):
            values["search_hashtags"] = tuple(t for t in env["SEARCH_HASHTAGS"].split(",") if t.strip())
        for variable, name in (("MAX_TWEETS", "max_posts"), ("CUTOFF_HOURS", "cutoff_hours")):
            if env.get(variable):
                values[name] = int(env[variable])
        if env.get("OUTPUT_DIR"):
            values["output_dir"] = env["OUTPUT_DIR"]
        return cls(**{**values, **overrides})
