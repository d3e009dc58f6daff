"""Run configuration (the six knobs of the original batch job plus our own choices)."""

from __future__ import annotations

from dataclasses import dataclass

# The genre vocabulary used by the original job's membership filter, in its
# order and spelling (three names differ from the public MovieLens list on purpose).
MOVIELENS_GENRES = (
    "Action", "Adventure", "Animation", "Childrens", "Comedy", "Crime", "Documentary",
    "Drama", "Fantasy", "FilmNoir", "Horror", "Musical", "Mystery", "Romance", "SciFi",
    "Thriller", "War", "Western",
)


@dataclass(frozen=True)
class RunConfig:
    k_values: tuple[int, ...] = (3, 5, 8)
    top_n: int = 10
    relevance_threshold: float = 4.0
    seed: int = 42
    train_fraction: float = 0.8
    # "hash" is layout independent and reproducible; "random" is Spark's randomSplit.
    split: str = "hash"
    genre_vocabulary: tuple[str, ...] = MOVIELENS_GENRES
    normalize_genres: bool = False
    sample_users: int = 20
    top_genres: int = 5
    # Buckets of the hash split; train_fraction must be a whole number of them.
    split_buckets: int = 10
    # K-Means fits of the sweep submitted concurrently (1 = one after another).
    fit_parallelism: int = 3
    # Tables of one K that are written at a time.
    write_parallelism: int = 4
    # Buckets of the stored layout by user (0: pairs are not stored), and the pairs from which a
    # user is kept apart from them.
    user_buckets: int = 0
    hot_user_rows: int = 1_000_000

    def __post_init__(self):
        if not self.k_values:
            raise ValueError("k_values must not be empty")
        if any(k < 2 for k in self.k_values):
            raise ValueError("every k must be >= 2")
        if self.top_n < 1:
            raise ValueError("top_n must be >= 1")
        if not 0.0 < self.train_fraction < 1.0:
            raise ValueError("train_fraction must be in (0, 1)")
        if self.split not in ("hash", "random"):
            raise ValueError("split must be 'hash' or 'random'")
        if self.split == "hash":
            train_buckets(self.train_fraction, self.split_buckets)


def train_buckets(train_fraction: float, buckets: int = 10) -> int:
    """Buckets ``[0, n)`` of the hash split are train. A fraction that is no whole number of
    buckets is an error, never rounded."""
    n = round(train_fraction * buckets)
    if abs(train_fraction * buckets - n) > 1e-9:
        raise ValueError(f"train_fraction {train_fraction} is no whole number of {buckets} buckets; "
                         "choose another split_buckets")
    if not 0 < n < buckets:
        raise ValueError("train_fraction leaves one side empty at this bucket count")
    return n


def parse_k_values(text: str) -> tuple[int, ...]:
    """``"3, 5,,8"`` -> ``(3, 5, 8)``: split on commas, strip, drop blanks."""
    return tuple(int(part.strip()) for part in text.split(",") if part.strip())


__all__ = ["RunConfig", "MOVIELENS_GENRES", "parse_k_values", "train_buckets"]
