"""Feature -> typed raw layer loaders.

Input: a features DataFrame ``(id STRING, properties MAP<STRING,STRING>, shape)``
as produced by :mod:`landlens.sources.geojson` (or derived layers). Each loader
is a single ``select``/``filter`` so Catalyst prunes and pushes everything.
``canton_stats`` gives the kept/skipped counts of a canton filter in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R


def prop(name: str) -> F.Column:
    return F.col("properties").getItem(name)


def text(name: str) -> F.Column:
    """A property as plain text."""
    return R.plain(prop(name))


def _canton_ok(key: str, canton: str | None) -> F.Column:
    if not canton:
        return F.lit(True)
    return F.upper(F.coalesce(text(key), F.lit(""))) == canton.upper()


def canton_stats(features: DataFrame, key: str, canton: str) -> DataFrame:
    ok = _canton_ok(key, canton)
    return features.agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("skipped"))


def load_zoning_federal(features: DataFrame, canton: str | None = "VD") -> DataFrame:
    """Harmonised (federal) primary-use zoning layer."""
    return (features.where(_canton_ok("canton", canton))
            .select(R.first_nonempty(F.col("id"), prop("t_id"), default="").alias("zone_id"),
                    F.lit(None).cast("int").alias("commune_bfs"),
                    R.first_nonempty(prop("type_canton_designation"),
                                     prop("affectation_principale_designation"), default="").alias("typ_kt"),
                    text("affectation_principale_designation").alias("hauptnutzung"),
                    R.build_zone_federal(prop("affectation_principale_code")).alias("is_building_zone"),
                    "shape"))


def load_zoning_cantonal(features: DataFrame, *ride: str) -> DataFrame:
    """Cantonal zoning with code, parsed height limit and density index; the columns ``ride`` come along.

    ``hauptnutzung`` carries the COMMUNE name, as in the source loader.
    """
    code = R.strip(F.coalesce(text("ZONE"), F.lit("")))
    name = F.coalesce(R.nonempty(prop("NOM_ZONE")), F.lit(""))
    return features.select(
        R.first_nonempty(prop("OBJECTID"), F.col("id"), default="").alias("zone_id"),
        R.to_int(prop("NO_COMM_FEDERAL")).alias("commune_bfs"),
        name.alias("typ_kt"),
        text("COMMUNE").alias("hauptnutzung"),
        R.build_zone_cantonal(code, name).alias("is_building_zone"),
        code.alias("zone_code"),
        R.parse_height(prop("DESCRIPTION")).alias("height_limit_m"),
        text("INDICE").alias("density_indice"),
        "shape", *ride)


def load_parcels(features: DataFrame, canton: str | None = "VD") -> DataFrame:
    fid = R.first_nonempty(F.col("id"), prop("NBIdent"), default="")
    egrid = F.coalesce(R.nonempty(prop("EGRIS_EGRID")),
                       F.when(fid != "", F.concat(F.lit("SYN-"), fid)))
    return (features.where(_canton_ok("Kanton", canton))
            .select(fid.alias("source_id"), egrid.alias("egrid"),
                    R.to_int(prop("BFSNr")).alias("commune_bfs"),
                    text("Kanton").alias("commune_name"),
                    text("Nummer").alias("parcel_no"),
                    R.to_float(prop("Flaeche")).alias("area_m2"),
                    "shape"))


def landcover_kind() -> F.Column:
    return R.first_nonempty(prop("art"), prop("objektart"), prop("genre"), prop("type"), default="")


def load_buildings_landcover(features: DataFrame) -> DataFrame:
    """Keep land-cover polygons whose class names a building."""
    return (features.where(R.is_landcover_building(landcover_kind()))
            .select(F.coalesce(F.col("id"), F.lit("")).alias("bld_id"),
                    F.lit(None).cast("double").alias("footprint_m2"), "shape"))


def load_generic(features: DataFrame, columns: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """id + named properties + geometry (planning zones, forest, ...); ``types`` names SQL types other than text."""
    sel = [F.coalesce(F.col("id"), F.lit("")).alias(columns[0])]
    types = types or {}
    sel += [(R.to_int(prop(c)) if types.get(c) == "int" else text(c).try_cast(types[c]) if c in types else text(c)).alias(c) for c in columns[1:]]
    return features.select(*sel, "shape")


def load_buildings_floors(features: DataFrame) -> DataFrame:
    """Building footprints with above-ground floors, height and year."""
    return features.select(
        R.to_int(prop("OBJECTID")).cast("bigint").alias("objectid"),
        text("EGID").alias("egid"), text("COMMUNE").alias("commune"),
        text("DESTINATION").alias("destination"), text("NOMEN_CLASSE").alias("nomen_classe"),
        R.to_int(prop("NIVEAUX_HORSOL")).alias("floors"),
        R.to_float(prop("HAUTEUR")).alias("hauteur"),
        R.to_int(prop("ANNEE_CONSTRUCTION")).alias("annee_constr"),
        R.to_float(R.first_nonempty(prop("SURFACE"), prop("SHAPE.AREA"))).alias("footprint_m2"),
        "shape")


def load_raisable(features: DataFrame) -> DataFrame:
    return features.select(
        R.to_int(prop("OBJECTID")).cast("bigint").alias("objectid"),
        text("EGID").alias("egid"), text("COMMUNE").alias("commune"),
        text("DESTINATION").alias("destination"), text("REMARQUE").alias("remarque"),
        "shape")
