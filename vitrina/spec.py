"""What a catalog table looks like: key, typed columns, dimensions, thresholds."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

# They decide results and must not be changed.
MISSING_TOKENS = ("", "nan", "null", "none", "n/a", "na")
LITERAL_COLUMNS = ("name", "slug")
INTEGER_COLUMNS = (
    "rating_top",
    "ratings_count",
    "reviews_text_count",
    "added",
    "metacritic",
    "suggestions_count",
    "reviews_count",
    "movies_count",
    "reddit_count",
    "achievements_count",
    "youtube_count",
    "creators_count",
    "twitch_count",
    "parent_achievements_count",
    "additions_count",
    "screenshots_count",
    "game_series_count",
    "parents_count",
)
FLOAT_COLUMNS = ("rating", "playtime")
DIMENSION_COUNTS = {
    "genres": "genres_count",
    "platforms": "platforms_count",
    "developers": "developers_count_clean",
    "publishers": "publishers_count",
}
MULTI_VALUE_TEXT = (
    "platforms",
    "stores",
    "developers",
    "genres",
    "tags",
    "publishers",
    "esrb_rating",
    "added_by_status",
    "ratings",
    "parent_platforms",
    "metacritic_platforms",
    "alternative_names",
    "tba",
)
PROFILED_COLUMNS = (
    "released",
    "background_image",
    "rating",
    "rating_top",
    "ratings_count",
    "reviews_text_count",
    "added",
    "metacritic",
    "playtime",
    "suggestions_count",
    "reviews_count",
    "platforms",
    "developers",
    "genres",
    "publishers",
    "esrb_rating",
    "description",
    "description_raw",
    "tba",
)
CLEAN_TYPES = {
    "id": "bigint",
    "released": "date",
    "release_year": "int",
    "rating": "double",
    "rating_top": "bigint",
    "ratings_count": "bigint",
    "metacritic": "bigint",
    "playtime": "double",
    "reviews_count": "bigint",
    "genres_count": "int",
    "platforms_count": "int",
    "developers_count_clean": "int",
    "publishers_count": "int",
}
LITERAL_ROWS = (
    (100122, "NULL", "null"),
    (468408, "None", "none"),
    (119609, "NaN", "nan"),
)
EXPECTED_ROWS = 899_585
EXPECTED_COLUMNS = 60
EXPECTED_YEARS = (1954, 2033)
MINIMUM_ROWS = 500_000
TOLERANCE = 1e-4


@dataclass(frozen=True)
class CatalogSpec:
    """Column roles of a catalog.

    ``unique_key`` promises that every row has its own non-NULL key. With that promise
    an item counts once per dimension value without comparing rows, so the grouped
    queries need no shuffle of the exploded table. Without it (the default) pairs of
    key and value are made distinct first. ``normalized`` promises that dimensions are
    as ``plans.cleaning`` leaves them, so that they need no stripping when they are
    split. ``plans.validation`` checks both promises.
    """

    key: str = "id"
    unique_key: bool = False
    normalized: bool = False
    literal_columns: tuple[str, ...] = LITERAL_COLUMNS
    integer_columns: tuple[str, ...] = INTEGER_COLUMNS
    float_columns: tuple[str, ...] = FLOAT_COLUMNS
    date_column: str = "released"
    year_column: str = "release_year"
    json_column: str = "esrb_rating"
    json_path: str = "$.name"
    json_field: str = "esrb_rating_name"
    dimensions: Mapping[str, str] = field(
        default_factory=lambda: MappingProxyType(dict(DIMENSION_COUNTS))
    )
    top_k: int = 20
    rating_support: int = 50
    metacritic_support: int = 20
    playtime_support: int = 30
    # Metrics with few distinct values whatever the number of items.
    few_valued: tuple[str, ...] = ("rating", "metacritic", "playtime")

    @property
    def numeric_columns(self) -> tuple[str, ...]:
        """Columns that should hold numbers, floats first."""
        return self.float_columns + self.integer_columns
