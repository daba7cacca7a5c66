"""Attribute rules as native Column expressions (no Python UDFs).

The constants below must equal the source pipeline's for identical results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must match the source pipeline) ---------------------------
CANTONAL_BUILD_PREFIXES = ("D", "1", "2", "3", "4", "5")
CANTONAL_NONBUILD_TOKENS = ("agricole", "bois", "forêt", "foret", "protégée",
                            "protegee", "verdure", "ferroviaire", "eaux")
FEDERAL_BUILD_CODES = (11, 12, 13, 14, 15, 16, 18, 19, 41, 43)
TEXT_BUILD_TOKENS = ("habitation", "logement", "activit", "mixte", "centr", "urbanis",
                     "à bâtir", "a batir", "constructible", "wohn", "arbeit", "misch", "zentrum")
TEXT_NONBUILD_TOKENS = ("agricol", "landwirtschaft", "forêt", "foret", "wald", "protect",
                        "schutz", "différé", "differe", "utilité publique", "verdure", "transport")
LANDCOVER_BUILDING_TOKENS = ("gebaeude", "gebäude", "batiment", "bâtiment", "edificio", "building")
HEIGHT_PATTERN = r"(?iU)gabarit\s+max(?:imum)?\.?\s*(\d{1,2})\s*m"
BLOCKING_THEMES = ("ForestPerimeters", "NoiseSensitivityLevels", "ContaminatedSites",
                   "GroundwaterProtectionZones")
TARGET_CODES = ("D4A", "D4B")
SECONDARY_CODES = ("D2", "D3", "DAM", "DIA", "D5", "2", "3", "4A", "4B")
AVOID_CODES = ("5", "1")
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _any_token(s: Column, tokens) -> Column:
    out = F.lit(False)
    for t in tokens:
        out = out | s.contains(t)
    return out


def strip(v) -> Column:
    """Text without leading and trailing Unicode white space."""
    return F.regexp_replace(_c(v).cast("string"), r"(?U)^\s+|\s+$", "")


def to_int(v) -> Column:
    """Whole number of a text (white space around it is fine, a fraction is not) or of a JSON number (cut off)."""
    s = strip(plain(v))
    cut = F.when(is_number(v) & s.rlike(r"^[+-]?[0-9]+[.][0-9]+$"), F.regexp_extract(s, r"^[+-]?[0-9]+", 0)).otherwise(s)
    return F.when(cut.rlike(r"^[+-]?[0-9]+$"), cut.try_cast("int"))


def to_float(v) -> Column:
    """Decimal number of a text; no type suffixes such as ``12d``."""
    s = strip(plain(v))
    return F.when(s.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), s.try_cast("double"))


#: Marks a property that the JSON held as a number; see ``sources.geojson``.
NUMBER_MARK = "\u0001"


def is_number(v) -> Column:
    return F.coalesce(_c(v).cast("string").startswith(NUMBER_MARK), F.lit(False))


def plain(v) -> Column:
    """A property's text without its number mark."""
    return F.regexp_replace(_c(v).cast("string"), f"^{NUMBER_MARK}", "")


def nonempty(v) -> Column:
    """NULL, empty text and a JSON number equal to zero are empty."""
    s = _c(v).cast("string")
    zero = is_number(s) & (plain(s).try_cast("double") == 0)
    return F.when((s != "") & ~F.coalesce(zero, F.lit(False)), plain(s))


def first_nonempty(*vals, default=None) -> Column:
    """``a or b or ... or default`` with Python string truthiness."""
    parts = [nonempty(v) for v in vals]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def parse_height(description) -> Column:
    """First gabarit height in the text as INT, NULL when absent."""
    return F.regexp_extract(_c(description), HEIGHT_PATTERN, 1).try_cast("int")


def build_zone_federal(code) -> Column:
    return F.coalesce(to_int(code).isin(*FEDERAL_BUILD_CODES), F.lit(False))


def build_zone_cantonal(code, name) -> Column:
    nm = F.lower(F.coalesce(plain(name), F.lit("")))
    c = F.upper(strip(F.coalesce(_c(code).cast("string"), F.lit(""))))
    starts = F.lit(False)
    for p in CANTONAL_BUILD_PREFIXES:
        starts = starts | c.startswith(p)
    return F.when(_any_token(nm, CANTONAL_NONBUILD_TOKENS), False).when(c == "", False).otherwise(starts)


def build_zone_text(use) -> Column:
    s = F.lower(plain(use))
    return (F.when(F.coalesce(s, F.lit("")) == "", False)
            .when(_any_token(s, TEXT_NONBUILD_TOKENS), False)
            .otherwise(_any_token(s, TEXT_BUILD_TOKENS)))


def is_landcover_building(kind) -> Column:
    return _any_token(F.lower(F.coalesce(_c(kind), F.lit(""))), LANDCOVER_BUILDING_TOKENS)


def localized_text(field: str, lang: str = "fr") -> Column:
    """Multilingual text list -> preferred language text, else the first one.

    ``field`` is ARRAY<STRUCT<Language, Text>>. As with a dict built from the
    list, the last duplicate of a language wins and "first" means the language
    seen first (with its last text).
    """
    items = f"filter({field}, t -> t IS NOT NULL)"
    pick = F.expr(f"try_element_at(filter({items}, t -> t.Language = '{lang}'), -1).Text")
    first = F.expr(f"try_element_at(filter({items}, t -> t.Language <=> "
                   f"try_element_at({items}, 1).Language), -1).Text")
    return F.when(F.size(F.expr(items)) > 0, F.coalesce(F.nullif(pick, F.lit("")), first))


def zone_tier(code) -> Column:
    c = _c(code)
    return (F.when(c.isin(*TARGET_CODES), "target")
            .when(c.isin(*SECONDARY_CODES), "secondary")
            .when(c.isin(*AVOID_CODES), "avoid")
            .otherwise("secondary"))
