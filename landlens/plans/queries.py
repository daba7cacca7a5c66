"""Registered queries: one per operator / job of the land-opportunity pipeline.

Each query takes ``(spark, folder)`` and returns a DataFrame over the whole
tables in the folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .inputs import Layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


PARCEL_COLS = ["egrid", "source_id", "commune_bfs", "commune_name", "parcel_no", "area_m2", "zone_type",
               "primary_use", "is_building_zone", "in_planning_zone", "forest_overlap_m2", "developable_m2",
               "building_footprint_m2", "oereb_checked", "oereb_blocking"]
ZONE_A_COLS = ["zone_id", "commune_bfs", "commune_name", "zone_type", "primary_use", "zone_code",
               "height_limit_m", "density_indice", "area_m2", "forest_overlap_m2", "in_planning_zone",
               "developable_m2", "zone_tier", "signal_large_zone", "signal_plan_revision",
               "signal_low_fragment", "score_reasons"]
ZONE_B_COLS = ["zone_id", "zone_tier", "n_buildings", "built_footprint_m2", "built_floor_area_m2",
               "n_raisable", "score_reasons"]
ZONE_B_R6 = ["avg_floors", "permitted_floor_m2", "utilisation_pct", "coverage_pct", "underuse_score",
             "opportunity_score"]
COMMUNE_COLS = ["commune_bfs", "commune_name", "n_building_zones", "total_developable_m2",
                "n_in_plan_revision", "largest_zone_m2", "headline"]


# ---------------------------------------------------------------- jobs ------
@query("job_enrich_parcels")
def job_enrich_parcels(spark, d):
    return Layers(spark, d).enriched.select(*PARCEL_COLS, "coverage_ratio")


@query("job_score_parcels")
def job_score_parcels(spark, d):
    return Layers(spark, d).scored.select(
        "egrid", "developable_m2", "signal_underuse", "signal_servicing", "signal_assembly",
        "opportunity_score")


@query("job_zone_phase_a")
def job_zone_phase_a(spark, d):
    return Layers(spark, d).zones_a.select(*ZONE_A_COLS, "opportunity_score")


@query("job_zone_phase_b")
def job_zone_phase_b(spark, d):
    return Layers(spark, d).zones_b.select(*ZONE_B_COLS, *ZONE_B_R6)


@query("job_communes_a")
def job_communes_a(spark, d):
    return Layers(spark, d).communes_a.select(*COMMUNE_COLS, "top_zone_score", "commune_score")


@query("job_communes_b")
def job_communes_b(spark, d):
    return Layers(spark, d).communes_b.select(*COMMUNE_COLS, "top_zone_score", "commune_score")


# ------------------------------------------------------------- argmax -------
@query("argmax_zone")
def argmax_zone(spark, d):
    e = Layers(spark, d).enriched
    return e.where(F.col("dominant_zone_id").isNotNull()).select(
        "egrid", "dominant_zone_id", "zone_type", "primary_use", "is_building_zone")


# ===================================================================== more ==
import uuid  # noqa: E402

from ..functions import geometry as G  # noqa: E402
from ..functions import rules as R  # noqa: E402
from ..operators import state as S  # noqa: E402
from ..operators.clipped import clipped_pairs  # noqa: E402
from ..operators.spatial_join import spatial_join  # noqa: E402
from ..sources import derived as D  # noqa: E402
from ..sources.bucketed import BucketedTable  # noqa: E402
from ..sources import geojson as J  # noqa: E402
from ..sources import layout as LY  # noqa: E402
from ..sources import loaders as LD  # noqa: E402
from ..sources import paging as PG  # noqa: E402
from ..sources.store import TableStore  # noqa: E402
from . import changes as C  # noqa: E402
from . import landed as LA  # noqa: E402
from . import parcels as P  # noqa: E402
from . import profile as PR  # noqa: E402
from . import reports as RP  # noqa: E402
from . import run as RN  # noqa: E402
from . import zones as Z  # noqa: E402


def _proj(name: str, product: str, cols: list, where=None):
    """Register a projection of a product; column builders run lazily."""
    def fn(spark, d):
        df = getattr(Layers(spark, d), product)
        if where is not None:
            df = df.where(where())
        return df.select(*[c() if callable(c) else c for c in cols])
    QUERIES[name] = fn


def _store(spark) -> TableStore:
    base = TableStore(spark)
    return TableStore(spark, f"{base.root}/{uuid.uuid4().hex}")


def _bbox_cols(s: str = "shape"):
    return [F.col(f"{s}.xmin").alias("xmin"), F.col(f"{s}.ymin").alias("ymin"),
            F.col(f"{s}.xmax").alias("xmax"), F.col(f"{s}.ymax").alias("ymax")]


# ---------------------------------------------------- 2.4 derived columns --
_proj("zone_base_filter", "zones_a", ["zone_id", "area_m2", "n_parts"])
_proj("zone_tier", "zones_a", ["zone_id", "zone_code", "zone_tier"])
_proj("developable_parcel", "enriched",
      ["egrid", "is_building_zone", "area_m2", "forest_overlap_m2", "developable_m2"])
_proj("developable_zone", "zones_a", ["zone_id", "area_m2", "forest_overlap_m2", "developable_m2"])
_proj("coverage_ratio", "enriched", ["egrid", "building_footprint_m2", "coverage_ratio"])
_proj("sig_underuse", "scored", ["egrid", "signal_underuse"])
_proj("sig_servicing", "scored", ["egrid", "signal_servicing"])
_proj("parcel_score", "scored", ["egrid", "score_raw"])
_proj("parcel_score_zero", "scored", ["egrid", "score_zeroed", "opportunity_score"])
_proj("sig_zone_flags", "zones_a", ["zone_id", "signal_large_zone", "signal_plan_revision", "signal_low_fragment"])
_proj("zone_score_a", "zones_a", ["zone_id", "opportunity_score"])
_proj("zone_reasons_a", "zones_a", ["zone_id", "score_reasons"])
_proj("permitted_floor", "zones_b", ["zone_id", "permitted_floor_m2"])
_proj("utilisation_pct", "zones_b", ["zone_id", "utilisation_pct", "coverage_pct"])
_proj("underuse_score", "zones_b", ["zone_id", "underuse_score"])
_proj("final_score", "zones_b", ["zone_id", "zone_tier", "opportunity_score"])
_proj("zone_reasons_b", "zones_b", ["zone_id", "score_reasons"])
_proj("lead_status", "zones_b", ["zone_id", lambda: RP.lead_status().alias("lead_status")],
      where=lambda: F.col("zone_tier") == "target")
_proj("commune_label", "communes_b", ["commune_bfs", lambda: RP.commune_label().alias("commune_label")])
_proj("parse_height", "zoning", ["zone_id", "height_limit_m"])
_proj("build_zone_cantonal", "zoning", ["zone_id", "zone_code", "typ_kt", "is_building_zone"])
_proj("load_zoning_cantonal", "zoning",
      ["zone_id", "commune_bfs", "typ_kt", "hauptnutzung", "is_building_zone", "zone_code",
       "height_limit_m", "density_indice"])
_proj("load_restrictions", "restrictions", ["egrid", "theme_code", "theme_text", "sub_theme", "legal_state"])
_proj("surrogate_key", "enriched", ["egrid", lambda: F.sha2(F.col("pkey"), 256).alias("parcel_uid")])


@query("score_reset")
def score_reset(spark, d):
    """Rescoring an already scored table recomputes every signal from scratch."""
    L = Layers(spark, d)
    again = P.score(L.scored.drop("score_raw", "score_zeroed"), adjacent=L.adjacent)
    return again.select("egrid", "signal_underuse", "signal_servicing", "signal_assembly", "opportunity_score")


@query("predicates")
def predicates(spark, d):
    e = Layers(spark, d).enriched
    cond = ((F.col("coverage_ratio") < 0.25) & ~F.coalesce(F.col("oereb_blocking"), F.lit(False))
            & (F.col("zone_type").startswith("Zone S") | F.col("primary_use").isin("NATION_1", "NATION_2"))
            & F.col("developable_m2").between(1000, 2300) & F.col("commune_bfs").isNotNull()
            & ~F.col("zone_type").contains("agricole"))
    return e.where(cond).select("egrid")


def _federal(spark, d):
    return D.federal_zoning_features(spark, d)


@query("load_zoning_federal")
def load_zoning_federal(spark, d):
    return LD.load_zoning_federal(_federal(spark, d)).drop("shape")


@query("build_zone_federal")
def build_zone_federal(spark, d):
    f = _federal(spark, d)
    return f.select(LD.prop("t_id").alias("t_id"),
                    R.build_zone_federal(LD.prop("affectation_principale_code")).alias("is_building_zone"))


@query("build_zone_text")
def build_zone_text(spark, d):
    f = _federal(spark, d)
    return f.select(LD.prop("t_id").alias("t_id"),
                    R.build_zone_text(LD.prop("affectation_principale_designation")).alias("use_is_building"),
                    R.build_zone_text(LD.prop("type_canton_designation")).alias("label_is_building"))


@query("first_nonempty")
def first_nonempty(spark, d):
    f = _federal(spark, d)
    return f.select(LD.prop("t_id").alias("t_id"),
                    R.first_nonempty(F.col("id"), LD.prop("t_id"), default="").alias("zone_id"),
                    R.first_nonempty(LD.prop("type_canton_designation"),
                                     LD.prop("affectation_principale_designation"), default="").alias("typ_kt"))


@query("safe_cast")
def safe_cast(spark, d):
    f = Layers(spark, d).zoning_features
    return f.select("id", R.to_int(LD.prop("NO_COMM_FEDERAL")).alias("bfs_int"),
                    R.to_float(LD.prop("INDICE")).alias("indice_float"))


@query("canton_filter_stats")
def canton_filter_stats(spark, d):
    a = LD.canton_stats(_federal(spark, d), "canton", "VD").select(F.lit("zoning").alias("layer"), "*")
    b = LD.canton_stats(D.parcel_features(spark, d), "Kanton", "VD").select(F.lit("parcels").alias("layer"), "*")
    return a.unionByName(b)


@query("load_parcels")
def load_parcels(spark, d):
    return LD.load_parcels(D.parcel_features(spark, d)).drop("shape")


@query("load_buildings_landcover")
def load_buildings_landcover(spark, d):
    return LD.load_buildings_landcover(D.landcover_features(spark, d)).select("bld_id")


@query("load_generic")
def load_generic(spark, d):
    return LD.load_generic(D.planning_features(spark, d), ["pz_id", "commune_bfs", "status", "valid_from"],
                           {"commune_bfs": "int", "valid_from": "date"}).drop("shape")


@query("load_buildings_floors")
def load_buildings_floors(spark, d):
    return LD.load_buildings_floors(D.building_floor_features(spark, d)).drop("shape")


@query("load_raisable")
def load_raisable(spark, d):
    return LD.load_raisable(D.raisable_features(spark, d)).drop("shape")


@query("flatten_restrictions")
def flatten_restrictions(spark, d):
    return J.flatten_extracts(Layers(spark, d).extracts)


@query("localized_text")
def localized_text(spark, d):
    return J.flatten_extracts(Layers(spark, d).extracts).select("egrid", "theme_code", "theme_text")


# ------------------------------------------------------------ 2.3 geometry --
def _parsed_ok(L):
    return L.zoning_parsed.where(F.col("status") != "rejected")


@query("geo_parse")
def geo_parse(spark, d):
    z = _parsed_ok(Layers(spark, d))
    return z.select("id", "page_no", F.col("shape.nparts").alias("nparts"), *_bbox_cols(),
                    F.col("shape.area").alias("area_m2"))


@query("geo_valid_screen")
def geo_valid_screen(spark, d):
    return Layers(spark, d).zoning_parsed.select("id", "status", "reason")


@query("geo_polygons_only")
def geo_polygons_only(spark, d):
    z = Layers(spark, d).zoning_parsed.where(J.geometry_type("geometry") == "GeometryCollection")
    return z.select("id", G.num_parts("geom").alias("nparts"), G.area("geom").alias("area_m2"))


@query("geo_multi")
def geo_multi(spark, d):
    z = _parsed_ok(Layers(spark, d)).where(J.geometry_type("geometry") == "Polygon")
    return z.select("id", G.num_parts("geom").alias("nparts"))


@query("geo_area")
def geo_area(spark, d):
    return _parsed_ok(Layers(spark, d)).select("id", G.area("geom").alias("area_m2"))


@query("geo_bbox")
def geo_bbox(spark, d):
    b = _parsed_ok(Layers(spark, d)).select("id", G.bbox("geom").alias("b"))
    return b.select("id", *_bbox_cols("b"))


@query("geo_num_parts")
def geo_num_parts(spark, d):
    return _parsed_ok(Layers(spark, d)).select("id", G.num_parts("geom").alias("nparts"))


@query("geo_envelope")
def geo_envelope(spark, d):
    p = Layers(spark, d).parcels
    g = p.select("egrid", G.envelope(F.col("shape.xmin"), F.col("shape.ymin"), F.col("shape.xmax"),
                                     F.col("shape.ymax")).alias("geom"))
    return g.select("egrid", F.expr("size(geom[0][0])").alias("n_points"), G.area("geom").alias("area_m2"))


@query("geo_extent")
def geo_extent(spark, d):
    return Z.target_extent(Layers(spark, d).zones_a)


@query("agg_envelope")
def agg_envelope(spark, d):
    b = Layers(spark, d).buildings
    return b.agg(F.min("shape.xmin").alias("xmin"), F.min("shape.ymin").alias("ymin"),
                 F.max("shape.xmax").alias("xmax"), F.max("shape.ymax").alias("ymax"))


@query("geo_crs_detect")
def geo_crs_detect(spark, d):
    f = D.wgs84_zone_features(spark, d).withColumn("geom", J.geometry("geometry"))
    return PR.crs_of(f)


@query("geo_transform")
def geo_transform(spark, d):
    f = (D.wgs84_zone_features(spark, d).withColumn("g0", J.geometry("geometry"))
         .withColumn("geom", G.to_lv95("g0")))
    return f.select("id", F.expr("geom[0][0][0].x").alias("x0"), F.expr("geom[0][0][0].y").alias("y0"))


def _zone_pairs(L):
    z = _parsed_ok(L).select(F.col("id").alias("zone_id"), "shape")
    return clipped_pairs(L.parcels.select("egrid", "shape"), z, "egrid", "zone_id", P.PARCEL_CELL)


@query("geo_intersects")
def geo_intersects(spark, d):
    return _zone_pairs(Layers(spark, d)).select("egrid", "zone_id")


@query("geo_overlap_area")
def geo_overlap_area(spark, d):
    """To the millimetre squared: slanted edges are cut in other places than the whole shape's, so sums differ in their last bits."""
    return _zone_pairs(Layers(spark, d)).select("egrid", "zone_id", (F.floor(F.col("overlap_m2") * 1000 + 0.51) / 1000).alias("overlap_m2"))


@query("geo_dwithin")
def geo_dwithin(spark, d):
    p = Layers(spark, d).parcels.select("egrid", "shape")
    q = p.select(F.col("egrid").alias("other_egrid"), "shape")
    return (spatial_join(p, q, predicate="dwithin", distance=P.NEIGHBOUR_DISTANCE, cell=P.PARCEL_CELL)
            .where(F.col("egrid") != F.col("other_egrid")))


@query("geo_contains")
def geo_contains(spark, d):
    L = Layers(spark, d)
    z = L.zoning_table.select("zone_id", F.col("shape").alias("zshape"))
    pairs = spatial_join(z, L.parcels.select("egrid", "shape"), left_shape="zshape", keep_shapes=True,
                         cell=P.PARCEL_CELL)
    return pairs.where(F.expr(G.contains_sql("_ls", "_rs", True))).select("zone_id", "egrid")


# ------------------------------------------------------------- 2.1 sources --
@query("src_geojson_pages")
def src_geojson_pages(spark, d):
    z = _parsed_ok(Layers(spark, d))
    return LD.load_zoning_cantonal(z, "page_no").select(
        "zone_id", "page_no", "zone_code", "height_limit_m", "commune_bfs", "is_building_zone")


@query("src_page_status")
def src_page_status(spark, d):
    """Pages as landed files: written, read back line by line, every one accounted for."""
    path = _store(spark).root + "/landed_pages"
    J.write_pages(D.zoning_pages(spark, d), path)
    return J.page_status(J.read_pages(spark, path))


@query("src_extract_status")
def src_extract_status(spark, d):
    return J.extract_status(Layers(spark, d).extracts)


@query("src_bbox_read")
def src_bbox_read(spark, d):
    """Buildings stored along the curve, read by the box of the target and secondary zones (one row, known before the scan is planned)."""
    L = Layers(spark, d)
    path = _store(spark).root + "/buildings"
    LY.write_layer(L.buildings, path, (D.X0, D.Y0))
    box = Z.target_extent(L.zones_a).first()
    if box["xmin"] is None:
        return L.buildings.where(F.lit(False)).select("bld_id", "floors")
    return LY.read_box(spark, path, *box, rect_only=True).select("bld_id", "floors")


@query("src_feature_count")
def src_feature_count(spark, d):
    L = Layers(spark, d)
    out = None
    for name, df in [("parcels", L.parcels), ("zoning", L.zoning), ("buildings", L.buildings),
                     ("forest", L.forest), ("planning", L.planning), ("raisable", L.raisable),
                     ("restrictions", L.restrictions)]:
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
        out = c if out is None else out.unionByName(c)
    return out


@query("src_filter_fallback")
def src_filter_fallback(spark, d):
    z = Layers(spark, d).zoning.select("zone_id", "zone_code")
    a = PG.filter_or_all(z, F.col("zone_code") == "D4A").select(F.lit("D4A").alias("variant"), "zone_id", "branch")
    b = PG.filter_or_all(z, F.col("zone_code") == "ZZZ").select(F.lit("ZZZ").alias("variant"), "zone_id", "branch")
    return a.unionByName(b)


@query("src_restriction_extracts")
def src_restriction_extracts(spark, d):
    L = Layers(spark, d)
    ex = L.extracts.join(L.shortlist.select("egrid"), "egrid", "left_semi")
    return J.flatten_extracts(ex)


@query("src_table")
def src_table(spark, d):
    return Layers(spark, d).parcels.select("egrid", "commune_bfs", F.col("shape.area").alias("area_m2"))


# ------------------------------------------------------- 2.2 sinks / state --
@query("snk_replace_layer")
def snk_replace_layer(spark, d):
    st = _store(spark)
    z = Layers(spark, d).zoning.select("zone_id", "zone_code")
    st.replace(z.where(F.col("zone_code") == "D4A"), "zoning")
    st.replace(z, "zoning")  # TRUNCATE + reload: only the new version is visible
    return st.read("zoning")


def _upsert_inputs(L):
    b = L.enriched.select("egrid", "source_id", "commune_bfs", "commune_name", "parcel_no", "area_m2")
    k = F.col("source_id").cast("bigint")
    old = b.where(k % 3 != 0).select(
        "egrid", "source_id", "commune_bfs", "commune_name", "parcel_no", F.lit(1.0).alias("area_m2"),
        F.concat(F.lit("old-"), F.col("egrid")).alias("parcel_uid"),
        F.lit("2024-01-01").cast("date").alias("first_seen"), F.lit("Zone old").alias("zone_type"))
    new = b.where(k % 5 != 0).select(
        "egrid", F.concat(F.lit("n"), F.col("source_id")).alias("source_id"), "commune_bfs", "commune_name",
        "parcel_no", "area_m2", F.concat(F.lit("new-"), F.col("egrid")).alias("parcel_uid"),
        F.lit("2025-01-01").cast("date").alias("first_seen"))
    return old, new


@query("snk_upsert_parcel")
def snk_upsert_parcel(spark, d):
    """The table in key-hash buckets; the batch is merged twice, as by a job that is tried again: the second time changes nothing."""
    old, new = _upsert_inputs(Layers(spark, d))
    table = BucketedTable(spark, _store(spark).root + "/parcel", "egrid")
    table.create(old)
    for _ in range(2):
        table.upsert(new, ["area_m2", "commune_bfs", "commune_name", "parcel_no"])
    return table.read()


def _refreshed_restrictions(L):
    new = J.flatten_extracts(L.extracts.join(L.shortlist.select("egrid"), "egrid", "left_semi"))
    return S.replace_keys(L.restrictions, new, L.shortlist.select("egrid"), "egrid")


@query("snk_replace_keys")
def snk_replace_keys(spark, d):
    L = Layers(spark, d)
    keys = L.pin(L.shortlist.select("egrid"))
    table = BucketedTable(spark, _store(spark).root + "/restrictions", "egrid")
    table.create(L.restrictions)
    table.replace_keys(J.flatten_extracts(L.extracts.join(keys, "egrid", "left_semi")), keys)
    return table.read().select("egrid", "theme_code", "legal_state")


@query("join_key_list")
def join_key_list(spark, d):
    L = Layers(spark, d)
    return L.restrictions.join(L.shortlist.select("egrid"), "egrid", "left_anti").select(
        "egrid", "theme_code", "legal_state")


@query("snk_append_snapshot")
def snk_append_snapshot(spark, d):
    from .inputs import RUN3_TS
    st = _store(spark)
    rows = C.snapshot_rows(Layers(spark, d).scored, "run3", RUN3_TS)
    st.append(rows.drop("run_id"), "parcel_snapshot", "run3")
    st.append(rows.drop("run_id"), "parcel_snapshot", "run3")  # a retried run replaces its partition
    return st.read_log("parcel_snapshot").select("egrid", "content_hash", "run_id")


@query("snk_append_changes")
def snk_append_changes(spark, d):
    st = _store(spark)
    st.append(Layers(spark, d).changes, "change_log", "run3")
    return st.read_log("change_log").agg(F.count(F.lit(1)).alias("n_changes"))


@query("snk_additive_migrate")
def snk_additive_migrate(spark, d):
    z = Layers(spark, d).zones_a.select("zone_id", "opportunity_score")
    m = S.migrate(z, {"n_buildings": ("bigint", 0), "built_footprint_m2": ("double", 0.0),
                      "avg_floors": ("double", None), "n_raisable": ("bigint", 0)})
    return m.select("zone_id", "n_buildings", "built_footprint_m2", "avg_floors", "n_raisable")


@query("report_sink")
def report_sink(spark, d):
    st = _store(spark)
    st.replace(RP.top_leads(Layers(spark, d).zones_b), "report_top_leads")
    return st.read("report_top_leads").select("rank", "zone_id", "score_rounded", "util_rounded")


# ----------------------------------------------------------------- 2.5 joins --
@query("join_spatial_inner")
def join_spatial_inner(spark, d):
    L = Layers(spark, d)
    z = L.zoning_table.select("zone_id", F.col("shape").alias("zshape"))
    return spatial_join(L.parcels.select("egrid", "shape"), z, right_shape="zshape", with_overlap=True,
                        cell=P.PARCEL_CELL).select("egrid", "zone_id", "overlap_m2")


_proj("join_spatial_sum", "enriched", ["egrid", "forest_overlap_m2", "building_footprint_m2"])
_proj("join_spatial_count", "zones_b", ["zone_id", "n_raisable"])
_proj("join_zone_buildings", "zones_b",
      ["zone_id", "n_buildings", "built_footprint_m2", "built_floor_area_m2", "avg_floors"])
_proj("agg_zone_buildings", "zones_b",
      ["zone_id", "n_buildings", "built_footprint_m2", "built_floor_area_m2", "avg_floors"],
      where=lambda: F.col("n_buildings") > 0)


@query("join_spatial_exists")
def join_spatial_exists(spark, d):
    L = Layers(spark, d)
    a = L.enriched.select(F.lit("parcel").alias("kind"), F.col("egrid").alias("id"), "in_planning_zone")
    b = L.zones_a.select(F.lit("zone").alias("kind"), F.col("zone_id").alias("id"), "in_planning_zone")
    return a.unionByName(b)


@query("join_dwithin_self")
def join_dwithin_self(spark, d):
    return Layers(spark, d).adjacent.select(F.col("pkey").alias("egrid"))


@query("join_update_from")
def join_update_from(spark, d):
    L = Layers(spark, d)
    prior = L.parcels.select("egrid", F.lit("prior").alias("zone_type"), F.lit("prior").alias("primary_use"),
                             F.lit(False).alias("is_building_zone"))
    dom = L.enriched.where(F.col("dominant_zone_id").isNotNull()).select(
        "egrid", F.col("zone_type").alias("z_type"), F.col("primary_use").alias("z_use"),
        F.col("is_building_zone").alias("z_bz"))
    return S.update_from(prior, dom, "egrid", {"zone_type": "z_type", "primary_use": "z_use",
                                               "is_building_zone": "z_bz"})


@query("join_semi_checked")
def join_semi_checked(spark, d):
    L = Layers(spark, d)
    return L.parcels.join(L.restrictions.select("egrid"), "egrid", "left_semi").select("egrid")


@query("join_exists_blocking")
def join_exists_blocking(spark, d):
    return Layers(spark, d).enriched.where(F.col("oereb_blocking")).select("egrid")


@query("join_left_changes")
def join_left_changes(spark, d):
    L = Layers(spark, d)
    return C.diff(C.current_hashes(L.scored), C.latest(L.snapshots)).select("egrid", "new_hash", "old_hash")


# ---------------------------------------------------------- 2.6 aggregates --
_COMMUNE_AGG = ["commune_bfs", "n_building_zones", "total_developable_m2", "n_in_plan_revision",
                "largest_zone_m2", "top_zone_score", "commune_score"]
_proj("agg_commune_a", "communes_a", _COMMUNE_AGG)
_proj("agg_commune_b", "communes_b", _COMMUNE_AGG)
_proj("agg_headline_a", "communes_a", ["commune_bfs", "headline"])
_proj("agg_headline_b", "communes_b", ["commune_bfs", "headline"])


@query("agg_filtered_counts")
def agg_filtered_counts(spark, d):
    s = Layers(spark, d).scored
    return s.agg(F.count(F.lit(1)).alias("n_parcels"),
                 F.count_if(F.col("signal_underuse")).alias("n_underuse"),
                 F.count_if(F.col("signal_servicing")).alias("n_servicing"),
                 F.count_if(F.col("signal_assembly")).alias("n_assembly"),
                 F.count_if(F.col("oereb_blocking")).alias("n_blocked"),
                 F.count_if(F.col("oereb_checked")).alias("n_checked"),
                 F.sum(F.when(F.col("is_building_zone"), F.col("developable_m2"))).alias("developable_m2"))


@query("agg_count_distinct")
def agg_count_distinct(spark, d):
    return Layers(spark, d).zones_b.agg(F.countDistinct("commune_bfs").alias("n_communes"))


@query("agg_group_mix")
def agg_group_mix(spark, d):
    return RP.zone_mix(Layers(spark, d).zones_b).drop("pos")


@query("agg_run_counters")
def agg_run_counters(spark, d):
    L = Layers(spark, d)
    z = L.zones_b.agg(F.count_if(F.col("opportunity_score") > 0).alias("n_scored"),
                      F.count_if((F.col("zone_tier") == "target") & (F.col("utilisation_pct") < 40)).alias("n_leads"),
                      F.count_if(F.col("n_raisable") > 0).alias("n_with_raisable"),
                      F.countDistinct(F.coalesce(F.col("commune_bfs"), F.lit(-1))).alias("n_communes"))
    return z


@query("agg_distinct")
def agg_distinct(spark, d):
    return Layers(spark, d).restrictions.select("egrid").distinct()


# ------------------------------------------------------ 2.7 / 2.8 ranking --
@query("content_hash")
def content_hash(spark, d):
    return C.current_hashes(Layers(spark, d).scored)


@query("latest_snapshot")
def latest_snapshot(spark, d):
    """From the last state, merged run by run."""
    return Layers(spark, d).last_hashes


@query("topn_shortlist")
def topn_shortlist(spark, d):
    s = Layers(spark, d).scored.where(F.col("egrid").isNotNull() & (F.col("opportunity_score") > 0))
    return RP.top_k(s.select("egrid", "opportunity_score"), RP.TOP_SHORTLIST,
                    [F.col("opportunity_score").desc_nulls_last(), F.col("egrid").asc()])


@query("topn_communes")
def topn_communes(spark, d):
    c = Layers(spark, d).communes_b.where(F.coalesce(F.col("commune_score"), F.lit(0.0)) > 0)
    return RP.top_k(c.select("commune_bfs", "commune_score"), RP.TOP_COMMUNES,
                    [F.col("commune_score").desc(), F.col("commune_bfs").asc()], rank=None)


@query("topn_leads")
def topn_leads(spark, d):
    z = Layers(spark, d).zones_b.where((F.col("opportunity_score") > 0) & (F.col("zone_tier") == "target"))
    return RP.top_k(z.select("zone_id", "opportunity_score"), RP.TOP_LEADS,
                    [F.col("opportunity_score").desc(), F.col("zone_id").asc()], rank=None)


@query("order_mix")
def order_mix(spark, d):
    return RP.zone_mix(Layers(spark, d).zones_b)


@query("rank_number")
def rank_number(spark, d):
    return RP.top_communes(Layers(spark, d).communes_b).select("rank", "commune_bfs")


# ---------------------------------------------------------------- 2.11 jobs --
@query("job_detect_changes")
def job_detect_changes(spark, d):
    return Layers(spark, d).changes


@query("job_parcel_runs")
def job_parcel_runs(spark, d):
    """Two stateful runs: the first without prior state, the second with the same layers less the
    parcels of every third id. Every parcel of the state after the second run, with what the change log says of it."""
    L = Layers(spark, d)
    layers = [L.planning, L.forest, L.buildings, L.restrictions]
    one = RN.parcel_run(None, L.parcels, L.zoning_table, *layers, None, "run1", "2025-01-01 00:00:00")
    fewer = L.parcels.where(F.col("source_id").cast("bigint") % 3 != 0)
    two = RN.parcel_run(one.state, fewer, L.zoning_table, *layers, one.snapshots, "run2", "2025-01-02 00:00:00")
    log = one.changes.unionByName(two.changes).groupBy("egrid").agg(F.count(F.lit(1)).alias("n_changes"), F.max("detected_at").alias("last_change"))
    return (two.state.join(log, "egrid", "left")
            .select("egrid", "parcel_uid", "first_seen", "last_updated", "source_id", "area_m2", "zone_type", "primary_use", "is_building_zone", "developable_m2",
                    "opportunity_score", "n_changes", "last_change"))


@query("job_restriction_refresh")
def job_restriction_refresh(spark, d):
    """Shortlist -> extracts for those keys -> replace their restriction rows ->
    re-flag and re-score. The spatial overlay and the adjacency do not depend
    on the legal flags and are reused, not recomputed."""
    L = Layers(spark, d)
    e = P.apply_restrictions(L.overlaid, _refreshed_restrictions(L))
    return P.score(e, adjacent=L.adjacent).select(
        "egrid", "oereb_checked", "oereb_blocking", "signal_assembly", "opportunity_score")


def _millis(name: str) -> F.Column:
    """To a thousandth; halves, and what errors of 0.00001 make of them, go up."""
    return (F.floor(F.col(name) * 1000 + 0.51) / 1000).alias(name)


def _landed_run(spark, d, mode: str = "full"):
    folder = _store(spark).root + "/landing"
    LA.land(spark, d, folder)
    out = LA.run(spark, "full", folder)
    return out if mode == "full" else LA.run(spark, mode, raw=out.raw)


@query("job_full_run")
def job_full_run(spark, d):
    """Zones after both phases, from landed pages of all layers."""
    z = _landed_run(spark, d).zones
    return z.select("zone_id", "commune_bfs", "zone_tier", "n_parts", _millis("area_m2"), _millis("forest_overlap_m2"), "in_planning_zone", _millis("developable_m2"), "n_buildings",
                    _millis("built_footprint_m2"), _millis("built_floor_area_m2"), "n_raisable", _millis("utilisation_pct"), _millis("opportunity_score"), "score_reasons")


@query("job_full_run_parcels")
def job_full_run_parcels(spark, d):
    """Scored parcels of a refresh of the short list's restrictions, after a full run from landed pages and extracts."""
    p = _landed_run(spark, d, "oereb").parcels
    return p.select("egrid", "source_id", "commune_bfs", "dominant_zone_id", "is_building_zone", "in_planning_zone", _millis("forest_overlap_m2"), _millis("building_footprint_m2"),
                    _millis("developable_m2"), "oereb_checked", "oereb_blocking", _millis("opportunity_score"))


@query("src_load_report")
def src_load_report(spark, d):
    """Every landed page and feature by what became of it."""
    folder = _store(spark).root + "/landing"
    LA.land(spark, d, folder)
    return LA.load_report(spark, folder)


@query("job_guard_empty_layer")
def job_guard_empty_layer(spark, d):
    """Phase B with an empty building layer is skipped: Phase A scores stay."""
    L = Layers(spark, d)
    empty = L.buildings.where(F.lit(False))
    return Z.phase_b(L.zones_a, empty, L.raisable).select("zone_id", "opportunity_score", "n_buildings")


@query("report_kpis")
def report_kpis(spark, d):
    return RP.kpis(Layers(spark, d).zones_b)


@query("report_top_communes")
def report_top_communes(spark, d):
    return RP.top_communes(Layers(spark, d).communes_b)


@query("report_top_leads")
def report_top_leads(spark, d):
    return RP.top_leads(Layers(spark, d).zones_b)


@query("report_underuse")
def report_underuse(spark, d):
    return RP.underuse_summary(Layers(spark, d).zones_b)


@query("report_zone_mix")
def report_zone_mix(spark, d):
    return RP.zone_mix(Layers(spark, d).zones_b)


@query("report_pdf_kpis")
def report_pdf_kpis(spark, d):
    return RP.pdf_kpis(Layers(spark, d).zones_b)


@query("report_pdf_leads")
def report_pdf_leads(spark, d):
    return RP.pdf_leads(Layers(spark, d).zones_b)


# ----------------------------------------------------------- 2.12 profiling --
@query("prof_keys")
def prof_keys(spark, d):
    return PR.property_keys(Layers(spark, d).zoning_features.unionByName(
        D.federal_zoning_features(spark, d).withColumn("rects", F.lit(None)), allowMissingColumns=True))


@query("prof_low_card")
def prof_low_card(spark, d):
    return PR.value_counts(Layers(spark, d).zoning_features)


@query("prof_value_mix")
def prof_value_mix(spark, d):
    f = D.parcel_features(spark, d).select(F.col("properties")["Kanton"].alias("kanton"),
                                           F.col("properties")["NBIdent"].alias("nb"))
    f = f.withColumn("ord", F.expr("cast(substr(nb, 3) AS bigint)"))
    return PR.value_mix(f, "kanton", "ord", "VD")


@query("prof_crs")
def prof_crs(spark, d):
    f = D.wgs84_zone_features(spark, d).withColumn("geom", J.geometry("geometry"))
    return PR.crs_of(f).groupBy("crs").agg(F.count(F.lit(1)).alias("n"))


@query("prof_filter_works")
def prof_filter_works(spark, d):
    f = D.parcel_features(spark, d).select(F.col("properties")["Kanton"].alias("kanton"))
    a = PR.only_value(f.where(F.upper("kanton") == "VD"), "kanton", "VD").select(F.lit("upper").alias("probe"), "*")
    b = PR.only_value(f.where(F.col("kanton") == "VD"), "kanton", "VD").select(F.lit("exact").alias("probe"), "*")
    return a.unionByName(b)


@query("prof_keyword_hits")
def prof_keyword_hits(spark, d):
    return PR.keyword_hits(D.table(spark, d, "pages"), "page_id", "html")


@query("stream_restriction_refresh")
def stream_restriction_refresh(spark, d):
    """Shortlist extracts landed as files, applied by the streaming refresh job."""
    from ..streaming import restrictions as RS
    L = Layers(spark, d)
    st = _store(spark)
    st.replace(L.restrictions, "restrictions")
    landed = f"{st.root}/landed"
    L.extracts.join(L.shortlist.select("egrid"), "egrid", "left_semi").write.mode("overwrite").json(landed)
    q = RS.start(spark, landed, st, checkpoint=f"{st.root}/stream-checkpoint")
    q.awaitTermination()
    return st.read("restrictions").select("egrid", "theme_code", "theme_text", "legal_state")


# ------------------------------------------------- 2.10 scalar function groups --
@query("scalar_null")
def scalar_null(spark, d):
    e = Layers(spark, d).enriched
    return e.select("egrid", F.coalesce("oereb_blocking", F.lit(False)).alias("blocked"),
                    F.nullif(F.col("commune_bfs"), F.lit(6601)).alias("bfs_not_6601"),
                    (~F.col("oereb_blocking").eqNullSafe(F.lit(False))).alias("distinct_from_false"),
                    F.col("zone_type").isNull().alias("no_zone"))


@query("scalar_conditional")
def scalar_conditional(spark, d):
    z = Layers(spark, d).zones_b
    return z.select("zone_id", F.greatest(F.col("height_limit_m"), F.lit(12)).alias("h_at_least_12"),
                    F.least(F.col("utilisation_pct"), F.lit(50.0)).alias("util_capped"),
                    F.col("developable_m2").between(1000, 20000).alias("mid_size"),
                    F.col("zone_code").isin("D4A", "D4B", "3").alias("listed"),
                    (F.col("signal_large_zone") & (F.col("utilisation_pct") < 40)).alias("large_and_low"),
                    F.when(F.col("n_buildings") == 0, "empty").when(F.col("n_buildings") < 10, "few")
                    .otherwise("many").alias("density"))


@query("scalar_math")
def scalar_math(spark, d):
    z = Layers(spark, d).zones_b
    return z.select("zone_id", F.floor(F.col("height_limit_m") / 3.0).alias("storeys"),
                    RP.half_even(F.col("utilisation_pct")).alias("util_half_even"),
                    RP.half_up(F.col("utilisation_pct")).cast("bigint").alias("util_half_up"),
                    (F.col("built_floor_area_m2") / F.col("developable_m2")).alias("floor_ratio"))


@query("scalar_string")
def scalar_string(spark, d):
    z = Layers(spark, d).zoning
    return z.select("zone_id",
                    F.concat(F.lit("code "), F.col("zone_code"), F.col("density_indice")).alias("pipe_concat"),
                    F.concat_ws("", F.lit("h"), F.col("height_limit_m").cast("string")).alias("pg_concat"),
                    F.btrim(F.concat(F.lit(", "), F.col("typ_kt"), F.lit(", ,")), F.lit(", ")).alias("trimmed"),
                    F.md5(F.col("zone_id")).alias("md5_id"), F.upper(F.col("typ_kt")).alias("upper_type"),
                    F.lower(F.col("hauptnutzung")).rlike("nation_1[0-9]").alias("teen_nation"))


@query("scalar_cast")
def scalar_cast(spark, d):
    e = Layers(spark, d).enriched
    return e.select("egrid", F.rint(F.col("area_m2")).cast("bigint").cast("string").alias("area_text"),
                    F.col("is_building_zone").cast("string").alias("bz_text"),
                    F.col("parcel_no").try_cast("int").alias("parcel_int"),
                    R.to_int(F.concat(F.lit(" "), F.col("source_id"), F.lit(".5"))).alias("not_an_int"))


@query("scalar_datetime")
def scalar_datetime(spark, d):
    from .inputs import RUN3_TS
    p = Layers(spark, d).planning
    run = F.lit(RUN3_TS).cast("timestamp_ntz")  # one wall-clock stamp per run, zone-free
    return p.select("pz_id", "valid_from", run.alias("run_ts"),
                    (F.col("valid_from") <= F.to_date(run)).alias("in_force_at_run"),
                    F.datediff(F.to_date(run), F.col("valid_from")).alias("days_in_force"))


@query("scalar_json")
def scalar_json(spark, d):
    ev = D.table(spark, d, "events").select("event_id", "props", "value")
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                     F.to_json(F.struct(F.col("event_id").alias("id"),
                                        F.when(F.col("value") < 20, F.col("value")).alias("low_value")),
                               {"ignoreNullFields": "false"}).alias("doc"))


@query("scalar_array_map")
def scalar_array_map(spark, d):
    f = Layers(spark, d).zoning_features
    return f.select(F.col("id").alias("zone_id"), F.size(F.map_keys("properties")).alias("n_keys"),
                    F.expr("try_element_at(rects, 2).xmin").alias("second_part_xmin"),
                    F.size(F.filter("rects", lambda r: r["xmax"] - r["xmin"] > 200)).alias("n_wide_parts"))
