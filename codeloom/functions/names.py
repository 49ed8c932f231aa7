"""Column names of the tables and the dynamic column lists built from them."""

from __future__ import annotations

import re

# Column names of the catalog and of the published table.
PRODUCT_ID = "product_id"
EMBEDDING = "content_embedding"
LEAGUE = "league"
TEAM = "team"
HOT_MARKET = "is_hot_market"
LAUNCH_AGE = "launch_age_bucket"
DEDUP = "dedup"
ID_STRING = "code_id"
PREFIX_KEY = "prefix_key"
SET_VERSION = "embedding_set_version"
ID_VERSION = "code_version"
INPUT_COLUMNS = ["product_id", "content_embedding", "league", "team", "is_hot_market"]
METADATA_COLUMNS = [
    "league", "team", "brand", "color", "product_name", "price_band",
    "is_hot_market", "launch_age_bucket",
]
COMPARE_FIELDS = ["league", "team", "brand", "color", "price_band", "is_hot_market"]


def level_columns(num_levels: int) -> list[str]:
    return [f"c{level}" for level in range(1, num_levels + 1)]


def output_columns(num_levels: int) -> list[str]:
    return [PRODUCT_ID] + level_columns(num_levels) + [DEDUP, SET_VERSION, ID_VERSION]


def discover_levels(columns: list[str]) -> list[str]:
    """Level columns of a table; they must run from c1 without a gap."""
    numbers = sorted(int(name[1:]) for name in columns if re.fullmatch(r"c\d+", name))
    if not numbers:
        raise ValueError("the table has no level columns (c1, c2, ...)")
    if numbers != list(range(1, len(numbers) + 1)):
        raise ValueError(f"level columns {numbers} do not run from c1 to c{numbers[-1]}")
    return level_columns(len(numbers))


def check_mapping(columns: list[str]) -> list[str]:
    levels = discover_levels(columns)
    for needed in (DEDUP, PRODUCT_ID):
        if needed not in columns:
            raise ValueError(f"the mapping table lacks the column '{needed}'")
    return levels


def metadata_columns(columns: list[str]) -> list[str]:
    """Everything that is neither key, code, slot, id string nor packed key, in table order."""
    own = {PRODUCT_ID, DEDUP, ID_STRING, PREFIX_KEY, *discover_levels(columns)}
    return [name for name in columns if name not in own]
