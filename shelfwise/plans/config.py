"""Settings of the preparation and split jobs."""

from __future__ import annotations

from dataclasses import dataclass

from shelfwise import schemas as S


@dataclass(frozen=True)
class PrepareConfig:
    """How the catalogue is reduced before training."""

    min_samples_per_category: int = 50
    sampling_fraction: float = 1.0
    balance_strategy: str = "class_weight"
    min_reviews_per_book: int = 0
    key: str = S.KEY
    target: str = S.TARGET
    seed: int = 42
    undersample_cap: int | None = None

    def __post_init__(self):
        if self.balance_strategy not in ("class_weight", "undersample", "none"):
            raise ValueError(f"unknown balance strategy: {self.balance_strategy!r}")
        if self.balance_strategy == "undersample" and self.undersample_cap is None:
            raise ValueError("undersample needs undersample_cap")


@dataclass(frozen=True)
class SplitConfig:
    """How the prepared table is divided and where the parts go."""

    test_size: float = 0.2
    seed: int = 42
    target: str = S.TARGET
    key: str = S.KEY
    splits_name: str = "splits"
    info_name: str = "split_info"
