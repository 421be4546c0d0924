"""Country names and codes: a small dimension joined to result tables.

The list (ISO codes and English names) is a file beside this module, so labels are the
same on every cluster; other spellings are written down here.
"""

from __future__ import annotations

import csv
import json
import os
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings in common use next to the English display name.
OTHER_SPELLINGS = {
    "US": ["USA", "U.S.", "U.S.A.", "United States of America"],
    "GB": ["UK", "U.K.", "Great Britain", "England", "Scotland", "Wales"],
    "AE": ["UAE", "U.A.E."],
    "BA": ["Bosnia and Herzegovina", "Bosnia"],
    "BO": ["Plurinational State of Bolivia"],
    "CD": ["Democratic Republic of the Congo", "DR Congo", "Zaire"],
    "CG": ["Congo", "Republic of the Congo"],
    "CI": ["Ivory Coast", "Cote d'Ivoire", "Côte d'Ivoire"],
    "CN": ["People's Republic of China"],
    "CV": ["Cabo Verde"],
    "CZ": ["Czech Republic"],
    "HK": ["Hong Kong"],
    "IR": ["Islamic Republic of Iran"],
    "KP": ["Democratic People's Republic of Korea"],
    "KR": ["Republic of Korea", "Korea"],
    "LA": ["Lao People's Democratic Republic"],
    "MK": ["Macedonia"],
    "MM": ["Myanmar", "Burma"],
    "MO": ["Macao", "Macau"],
    "NL": ["Holland", "The Netherlands"],
    "PS": ["Palestine"],
    "RU": ["Russian Federation"],
    "SY": ["Syrian Arab Republic"],
    "SZ": ["Swaziland"],
    "TL": ["East Timor"],
    "TR": ["Turkey", "Türkiye"],
    "TT": ["Trinidad and Tobago"],
    "TZ": ["United Republic of Tanzania"],
    "VA": ["Holy See"],
    "VN": ["Viet Nam"],
}

# The regional indicator symbols A..Z, which form flags in pairs.
LETTERS = "".join(chr(ord("A") + i) for i in range(26))
FLAG_LETTERS = "".join(chr(0x1F1E6 + i) for i in range(26))

SCHEMA = "alias string, kind string, iso2 string, iso3 string, name string"

LIST = os.path.join(os.path.dirname(os.path.abspath(__file__)), "countries.csv")


def _key(text: str) -> str:
    return text.strip().upper()


@lru_cache(maxsize=4)
def listed(path: str = LIST) -> tuple[tuple[str, str, str], ...]:
    """(iso2, iso3, name) of every country, by iso2."""
    with open(path, newline="", encoding="utf-8") as file:
        return tuple((row["iso2"], row["iso3"], row["name"]) for row in csv.DictReader(file))


def _entries(path: str) -> list[tuple[str, str, str, str, str]]:
    found = []
    for iso2, iso3, name in listed(path):
        spellings = {_key(text) for text in [name, *OTHER_SPELLINGS.get(iso2, [])]}
        found += [(text, "name", iso2, iso3, name) for text in sorted(spellings)]
        found += [(iso2, "iso2", iso2, iso3, name), (iso3, "iso3", iso2, iso3, name)]
    return found


def country_dimension(spark: SparkSession, path: str = LIST) -> DataFrame:
    """alias (upper case), kind (name, iso2 or iso3), iso2, iso3, name."""
    return spark.createDataFrame(_entries(path), SCHEMA)


def _lookup(dimension: DataFrame, priority: list[str], prefix: str) -> DataFrame:
    """One row per alias: the entry whose kind comes first in ``priority``."""
    order = F.array_position(F.array(*[F.lit(kind) for kind in priority]), F.col("kind"))
    return (
        dimension.filter(F.col("kind").isin(priority))
        .groupBy(F.col("alias").alias(f"{prefix}alias"))
        .agg(F.min(F.struct(order.alias("o"), "iso2", "iso3", "name")).alias("hit"))
        .select(
            f"{prefix}alias",
            F.col("hit.iso2").alias(f"{prefix}iso2"),
            F.col("hit.iso3").alias(f"{prefix}iso3"),
            F.col("hit.name").alias(f"{prefix}name"),
        )
    )


def flag(iso2: Column) -> Column:
    return F.translate(iso2, LETTERS, FLAG_LETTERS)


def with_iso3(df: DataFrame, column: str, dimension: DataFrame, output: str = "iso3") -> DataFrame:
    """Add the ISO alpha-3 code: matched by name, else by alpha-2 code, else NULL.

    The dimension holds about a thousand rows whatever the data, so Catalyst's
    size check broadcasts it.
    """
    names = _lookup(dimension, ["name", "iso2"], "_c_")
    return (
        df.join(names, F.upper(F.trim(F.col(column))) == F.col("_c_alias"), "left")
        .withColumn(output, F.upper("_c_iso3"))
        .drop("_c_alias", "_c_iso2", "_c_iso3", "_c_name")
    )


def with_flag(
    df: DataFrame,
    column: str,
    dimension: DataFrame,
    output: str = "flag",
    label: bool = False,
    label_type: str = "name",
) -> DataFrame:
    """Add a flag, optionally followed by the country name or alpha-3 code.

    Matched by name, alpha-3, then alpha-2. Any other two letters count as an
    alpha-2 code without a name; everything else gives an empty string.
    """
    if label_type not in ("name", "iso3"):
        raise ValueError("label_type must be 'name' or 'iso3'")
    names = _lookup(dimension, ["name", "iso3", "iso2"], "_c_")
    code = F.coalesce(F.col("_c_iso2"), F.upper(F.col(column)))
    text = flag(code)
    if label:
        text = F.concat_ws(" ", text, F.coalesce(F.col(f"_c_{label_type}"), F.lit("NA")))
    return (
        df.join(names, F.upper(F.trim(F.col(column))) == F.col("_c_alias"), "left")
        .withColumn(output, F.when(code.rlike("^[A-Z]{2}$"), text).otherwise(""))
        .drop("_c_alias", "_c_iso2", "_c_iso3", "_c_name")
    )


def _constant_map(pairs: dict[str, str]) -> Column:
    """A map as one literal, folded when the query is planned."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def country_text(value: Column, label: bool = True, label_type: str = "name", path: str = LIST) -> Column:
    """What :func:`with_flag` adds, as an expression: for a few values, without a join."""
    if label_type not in ("name", "iso3"):
        raise ValueError("label_type must be 'name' or 'iso3'")
    order = {"name": 0, "iso3": 1, "iso2": 2}
    codes: dict[str, str] = {}
    for alias, _, iso2, _, _ in sorted(_entries(path), key=lambda entry: order[entry[1]]):
        codes.setdefault(alias, iso2)
    labels = {iso2: {"name": name, "iso3": iso3}[label_type] for iso2, iso3, name in listed(path)}
    code = F.coalesce(F.try_element_at(_constant_map(codes), F.upper(F.trim(value))), F.upper(value))
    text = flag(code)
    if label:
        text = F.concat_ws(" ", text, F.coalesce(F.try_element_at(_constant_map(labels), code), F.lit("NA")))
    return F.when(code.rlike("^[A-Z]{2}$"), text).otherwise("")
