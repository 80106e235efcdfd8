"""Derived columns on sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfwise.functions.draws import hash_number, weighted_choice

# The draw weight of the large counties in 1/100, the other counties, and
# those of them that count twice.
MAJOR_COUNTIES = {"Nairobi": 30, "Mombasa": 15, "Kisumu": 10, "Nakuru": 10, "Eldoret": 5}
OTHER_COUNTIES = (
    "Thika", "Malindi", "Kitale", "Garissa", "Kakamega", "Nyeri", "Meru", "Machakos", "Embu", "Nanyuki",
    "Kilifi", "Lamu", "Turkana", "Marsabit", "Isiolo", "Mandera", "Wajir", "Samburu", "West Pokot",
    "Baringo", "Laikipia", "Nyandarua", "Muranga", "Kiambu", "Uasin Gishu", "Elgeyo-Marakwet", "Nandi",
    "Bomet", "Kericho", "Narok", "Kajiado", "Makueni", "Kitui", "Taita-Taveta", "Kwale", "Tana River",
    "Homa Bay", "Migori", "Kisii", "Nyamira", "Siaya", "Busia", "Bungoma", "Trans Nzoia",
)
COUNTED_TWICE = ("Kilifi", "Lamu", "Uasin Gishu")


def county_weights() -> list[tuple[str, int]]:
    """County and integer draw weight, the large counties first.

    The others share what the large ones leave, evenly by how often each is counted.
    """
    counts = {name: 2 if name in COUNTED_TWICE else 1 for name in OTHER_COUNTIES}
    shares = sum(counts.values())
    rest = 100 - sum(MAJOR_COUNTIES.values())
    return [(name, weight * shares) for name, weight in MAJOR_COUNTIES.items()] + [
        (name, rest * count) for name, count in counts.items()
    ]


def add_county(
    df: DataFrame, key_cols: Sequence[str], name: str = "county", weights: Sequence[tuple[str, int]] | None = None
) -> DataFrame:
    """Add a county drawn by weight from the row's key; a frame that has one is left as it is."""
    if name in df.columns:
        return df
    return df.withColumn(name, weighted_choice(hash_number(key_cols), weights or county_weights()))
