"""DuckDB oracle SQL per registered query (same column names as the Spark side)."""

from __future__ import annotations

from .oracle_sql import sql

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *needs: str) -> None:
    ORACLE[name] = sql(body, *needs)


def r6(c: str) -> str:
    return c


PARCEL_COLS = ("egrid, source_id, commune_bfs, commune_name, parcel_no, area_m2, zone_type, primary_use, "
               "is_building_zone, in_planning_zone, forest_overlap_m2, developable_m2, building_footprint_m2, "
               "oereb_checked, oereb_blocking")
ZONE_A_COLS = ("zone_id, commune_bfs, commune_name, zone_type, primary_use, zone_code, height_limit_m, "
               "density_indice, area_m2, forest_overlap_m2, in_planning_zone, developable_m2, zone_tier, "
               "signal_large_zone, signal_plan_revision, signal_low_fragment, score_reasons")
ZONE_B_COLS = "zone_id, zone_tier, n_buildings, built_footprint_m2, built_floor_area_m2, n_raisable, score_reasons"
ZONE_B_R6 = ", ".join(r6(c) for c in ("avg_floors", "permitted_floor_m2", "utilisation_pct", "coverage_pct",
                                      "underuse_score", "opportunity_score"))
COMMUNE_COLS = ("commune_bfs, commune_name, n_building_zones, total_developable_m2, "
                "CAST(n_in_plan_revision AS BIGINT) AS n_in_plan_revision, largest_zone_m2, headline")

oracle("job_enrich_parcels", f"SELECT {PARCEL_COLS}, {r6('coverage_ratio')} FROM enriched", "enriched")
oracle("job_score_parcels",
       f"SELECT egrid, developable_m2, signal_underuse, signal_servicing, signal_assembly, "
       f"{r6('opportunity_score')} FROM scored", "scored")
oracle("job_zone_phase_a", f"SELECT {ZONE_A_COLS}, {r6('opportunity_score')} FROM zones_a", "zones_a")
oracle("job_zone_phase_b", f"SELECT {ZONE_B_COLS}, {ZONE_B_R6} FROM zones_b", "zones_b")
oracle("job_communes_a", f"SELECT {COMMUNE_COLS}, {r6('top_zone_score')}, {r6('commune_score')} FROM communes_a",
       "communes_a")
oracle("job_communes_b", f"SELECT {COMMUNE_COLS}, {r6('top_zone_score')}, {r6('commune_score')} FROM communes_b",
       "communes_b")
oracle("argmax_zone",
       "SELECT egrid, zone_id AS dominant_zone_id, typ_kt AS zone_type, hauptnutzung AS primary_use, "
       "is_building_zone FROM dominant", "dominant")


def proj(name: str, cols: str, src: str, where: str = "") -> None:
    oracle(name, f"SELECT {cols} FROM {src} {('WHERE ' + where) if where else ''}", src)


def _half_up(x: str, scale: int = 0) -> str:
    return f"round(CAST({x} AS DECIMAL(38,10)), {scale})"


def _build_text(x: str) -> str:
    non = "agricol|landwirtschaft|forêt|foret|wald|protect|schutz|différé|differe|utilité publique|verdure|transport"
    yes = "habitation|logement|activit|mixte|centr|urbanis|à bâtir|a batir|constructible|wohn|arbeit|misch|zentrum"
    return (f"CASE WHEN coalesce({x}, '') = '' THEN false WHEN regexp_matches(lower({x}), '{non}') THEN false"
            f" ELSE regexp_matches(lower({x}), '{yes}') END")


LEAD_STATUS = ("CASE WHEN coalesce(n_buildings, 0) = 0 THEN 'EMPTY' WHEN {u} IS NOT NULL AND {u} < 20 THEN 'barely built'"
               " WHEN {u} IS NOT NULL THEN 'underbuilt' ELSE '—' END"
               " || CASE WHEN coalesce(n_raisable, 0) <> 0 THEN ' · ' || n_raisable || ' raisable' ELSE '' END")

# ---------------------------------------------------------------- 2.4 ----
proj("zone_base_filter", "zone_id, area_m2, n_parts", "zones_a")
proj("zone_tier", "zone_id, zone_code, zone_tier", "zones_a")
proj("developable_parcel", "egrid, is_building_zone, area_m2, forest_overlap_m2, developable_m2", "enriched")
proj("developable_zone", "zone_id, area_m2, forest_overlap_m2, developable_m2", "zones_a")
proj("coverage_ratio", "egrid, building_footprint_m2, coverage_ratio", "enriched")
proj("sig_underuse", "egrid, signal_underuse", "scored")
proj("sig_servicing", "egrid, signal_servicing", "scored")
proj("parcel_score", "egrid, score_raw", "scored")
proj("parcel_score_zero", "egrid, score_zeroed, opportunity_score", "scored")
proj("sig_zone_flags", "zone_id, signal_large_zone, signal_plan_revision, signal_low_fragment", "zones_a")
proj("zone_score_a", "zone_id, opportunity_score", "zones_a")
proj("zone_reasons_a", "zone_id, score_reasons", "zones_a")
proj("permitted_floor", "zone_id, permitted_floor_m2", "zones_b")
proj("utilisation_pct", "zone_id, utilisation_pct, coverage_pct", "zones_b")
proj("underuse_score", "zone_id, underuse_score", "zones_b")
proj("final_score", "zone_id, zone_tier, opportunity_score", "zones_b")
proj("zone_reasons_b", "zone_id, score_reasons", "zones_b")
proj("lead_status", "zone_id, " + LEAD_STATUS.format(u=_half_up("utilisation_pct")) + " AS lead_status",
     "zones_b", "zone_tier = 'target'")
proj("commune_label", "commune_bfs, coalesce(commune_name, '(bfs ' || commune_bfs || ')') AS commune_label",
     "communes_b")
proj("parse_height", "zone_id, height_limit_m", "zoning")
proj("build_zone_cantonal", "zone_id, zone_code, typ_kt, is_building_zone", "zoning")
proj("load_zoning_cantonal", "zone_id, commune_bfs, typ_kt, hauptnutzung, is_building_zone, zone_code, "
     "height_limit_m, density_indice", "zoning")
proj("load_restrictions", "egrid, theme_code, theme_text, sub_theme, legal_state", "restrictions")
proj("surrogate_key", "egrid, sha256(egrid) AS parcel_uid", "enriched")
proj("score_reset", "egrid, signal_underuse, signal_servicing, signal_assembly, opportunity_score", "scored")
proj("predicates", "egrid", "enriched",
     "coverage_ratio < 0.25 AND NOT coalesce(oereb_blocking, false) AND (zone_type LIKE 'Zone S%' "
     "OR primary_use IN ('NATION_1', 'NATION_2')) AND developable_m2 BETWEEN 1000 AND 2300 "
     "AND commune_bfs IS NOT NULL AND NOT contains(zone_type, 'agricole')")

_FED_ID = "coalesce(nullif(fid, ''), nullif(t_id, ''), '')"
_FED_TYP = "coalesce(nullif(label, ''), nullif(designation, ''), '')"
_FED_BZ = ("coalesce(CASE WHEN regexp_matches(trim(code), '^[+-]?[0-9]+$') THEN CAST(trim(code) AS INTEGER) END"
           " IN (11, 12, 13, 14, 15, 16, 18, 19, 41, 43), false)")
proj("load_zoning_federal", f"{_FED_ID} AS zone_id, CAST(NULL AS INTEGER) AS commune_bfs, {_FED_TYP} AS typ_kt, "
     f"designation AS hauptnutzung, {_FED_BZ} AS is_building_zone", "federal", "upper(coalesce(canton, '')) = 'VD'")
proj("build_zone_federal", f"t_id, {_FED_BZ} AS is_building_zone", "federal")
proj("build_zone_text", f"t_id, {_build_text('designation')} AS use_is_building, "
     f"{_build_text('label')} AS label_is_building", "federal")
proj("first_nonempty", f"t_id, {_FED_ID} AS zone_id, {_FED_TYP} AS typ_kt", "federal")
oracle("safe_cast", "SELECT CAST(p AS VARCHAR) AS id, CASE WHEN regexp_matches(trim(bfs_txt), '^[+-]?[0-9]+$') "
       "THEN CAST(trim(bfs_txt) AS INTEGER) END AS bfs_int, CAST(p_size AS DOUBLE) AS indice_float FROM zoning_src",
       "zoning_src")
oracle("canton_filter_stats", """
SELECT 'zoning' AS layer, count(*) FILTER (WHERE upper(coalesce(canton, '')) = 'VD') AS kept,
       count(*) FILTER (WHERE upper(coalesce(canton, '')) <> 'VD') AS skipped FROM federal
UNION ALL
SELECT 'parcels', count(*) FILTER (WHERE upper(coalesce(kanton, '')) = 'VD'),
       count(*) FILTER (WHERE upper(coalesce(kanton, '')) <> 'VD') FROM pfeat""", "federal", "pfeat")
_FID = "coalesce(nullif(fid0, ''), nullif(nbident, ''), '')"
oracle("load_parcels", f"""
SELECT {_FID} AS source_id,
       coalesce(nullif(egris, ''), CASE WHEN {_FID} <> '' THEN 'SYN-' || {_FID} END) AS egrid,
       CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(6600 + k % 25 AS INTEGER) END AS commune_bfs,
       kanton AS commune_name, CAST(k % 1000 AS VARCHAR) AS parcel_no,
       CAST(CAST(round(o_totalprice) AS BIGINT) AS DOUBLE) AS area_m2
FROM pfeat WHERE upper(coalesce(kanton, '')) = 'VD'""", "pfeat")
oracle("load_buildings_landcover", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS bld_id FROM lineitem
WHERE l_linenumber % 5 IN (0, 4) OR (l_linenumber % 5 IN (1, 2) AND l_partkey % 3 IN (0, 1))""")
oracle("load_generic", """
SELECT 'PZ' || CAST(c_custkey AS VARCHAR) AS pz_id, CAST(6600 + c_custkey % 25 AS INTEGER) AS commune_bfs,
       CASE WHEN c_custkey % 60 = 0 THEN 'inForce' ELSE 'planned' END AS status, DATE '2025-01-01' AS valid_from
FROM customer""")
oracle("load_buildings_floors", """
SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS objectid, CAST(l_partkey AS VARCHAR) AS egid,
       'NATION_' || CAST(l_suppkey % 25 AS VARCHAR) AS commune, l_linestatus AS destination,
       l_returnflag AS nomen_classe,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(round(l_tax * 100) AS INTEGER) END AS floors,
       CAST(CAST(l_quantity AS INTEGER) * 3 AS DOUBLE) AS hauteur,
       CAST(1900 + l_partkey % 120 AS INTEGER) AS annee_constr,
       CAST(CAST(l_quantity AS INTEGER) * CASE WHEN l_linenumber % 3 = 0 THEN 5 ELSE 4 END AS DOUBLE) AS footprint_m2
FROM lineitem""")
oracle("load_raisable", """
SELECT CAST(c_custkey AS BIGINT) AS objectid, CAST(c_custkey * 7 AS VARCHAR) AS egid,
       'NATION_' || CAST(c_custkey % 25 AS VARCHAR) AS commune, c_mktsegment AS destination,
       CASE WHEN c_custkey % 2 = 0 THEN 'LCI art. 23' END AS remarque
FROM customer""")
proj("flatten_restrictions", "egrid, theme_code, theme_text, sub_theme, legal_state", "flat_extracts")
proj("localized_text", "egrid, theme_code, theme_text", "flat_extracts")

# ---------------------------------------------------------------- 2.3 ----
proj("geo_parse", "zone_id AS id, page_no, n_parts AS nparts, xmin, ymin, xmax, ymax, area_m2", "zparsed")
proj("geo_valid_screen", "zone_id AS id, status, reason", "zparsed_all")
proj("geo_polygons_only", "zone_id AS id, n_parts AS nparts, area_m2", "zparsed", "gtype = 'GeometryCollection'")
proj("geo_multi", "zone_id AS id, n_parts AS nparts", "zparsed", "gtype = 'Polygon'")
proj("geo_area", "zone_id AS id, area_m2", "zparsed")
proj("geo_bbox", "zone_id AS id, xmin, ymin, xmax, ymax", "zparsed")
proj("geo_num_parts", "zone_id AS id, n_parts AS nparts", "zparsed")
proj("geo_envelope", "egrid, 5 AS n_points, (xmax - xmin) * (ymax - ymin) AS area_m2", "parcels")
proj("geo_extent", "xmin, ymin, xmax, ymax", "envelope")
oracle("agg_envelope", "SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM buildings",
       "buildings")
oracle("geo_crs_detect", "SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 3 = 0 THEN 'WGS84' ELSE 'LV95' END "
       "AS crs FROM part")
_LAM = "((lon * 3600 - 26782.5::DOUBLE) / 10000)"
_PHI = "((lat * 3600 - 169028.66::DOUBLE) / 10000)"
_E = (f"(2600072.37::DOUBLE + 211455.93::DOUBLE * {_LAM} - 10938.51::DOUBLE * {_LAM} * {_PHI}"
      f" - 0.36::DOUBLE * {_LAM} * {_PHI} * {_PHI} - 44.54::DOUBLE * {_LAM} * {_LAM} * {_LAM})")
_N = (f"(1200147.07::DOUBLE + 308807.95::DOUBLE * {_PHI} + 3745.25::DOUBLE * {_LAM} * {_LAM}"
      f" + 76.63::DOUBLE * {_PHI} * {_PHI} - 194.56::DOUBLE * {_LAM} * {_LAM} * {_PHI}"
      f" + 119.79::DOUBLE * {_PHI} * {_PHI} * {_PHI})")
oracle("geo_transform", f"""
SELECT id, CASE WHEN deg THEN {_E} ELSE lon END AS x0, CASE WHEN deg THEN {_N} ELSE lat END AS y0 FROM (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_partkey % 3 = 0 AS deg,
         CASE WHEN p_partkey % 3 = 0 THEN 6.1::DOUBLE + (p_partkey % 20) * 0.004::DOUBLE
              ELSE 2500000.0::DOUBLE + (p_partkey % 20) * 288 END AS lon,
         CASE WHEN p_partkey % 3 = 0 THEN 46.2::DOUBLE + (p_partkey // 20) * 0.0006::DOUBLE
              ELSE 1110000.0::DOUBLE + (p_partkey // 20) * 60 END AS lat
  FROM part)""")
proj("geo_intersects", "egrid, zone_id", "zone_parcel")
proj("geo_overlap_area", "egrid, zone_id, floor(overlap_m2 * 1000 + 0.51) / 1000 AS overlap_m2", "zone_parcel")
def millis(*names: str) -> str:
    return ", ".join(f"floor({n} * 1000 + 0.51) / 1000 AS {n}" for n in names)


proj("job_full_run", f"zone_id, commune_bfs, zone_tier, n_parts, in_planning_zone, n_buildings, n_raisable, score_reasons, {millis('area_m2', 'forest_overlap_m2', 'developable_m2', 'built_footprint_m2', 'built_floor_area_m2', 'utilisation_pct', 'opportunity_score')}", "landed_zones_b")
proj("job_full_run_parcels", f"egrid, source_id, commune_bfs, dominant_zone_id, is_building_zone, in_planning_zone, oereb_checked, oereb_blocking, {millis('forest_overlap_m2', 'building_footprint_m2', 'developable_m2', 'opportunity_score')}", "landed_scored")
oracle("src_load_report", """
WITH n AS (SELECT 'parcels' AS layer, count(*) AS f, count(DISTINCT CAST(source_id AS BIGINT) // 40) AS p FROM parcels
  UNION ALL SELECT 'buildings', count(*), count(DISTINCT CAST(split_part(bld_id, '-', 1) AS BIGINT) // 40) FROM buildings
  UNION ALL SELECT 'raisable', count(*), count(DISTINCT objectid // 100) FROM raisable
  UNION ALL SELECT 'planning', count(*), count(DISTINCT CAST(pz_id AS BIGINT) // 40) FROM planning
  UNION ALL SELECT 'forest', count(*), count(DISTINCT CAST(fg_id AS BIGINT) // 40) FROM forest),
z AS (SELECT DISTINCT page_no FROM zparsed_all)
SELECT layer, 'page ok' AS status, p AS n FROM n UNION ALL SELECT layer, 'feature ok', f FROM n
UNION ALL SELECT 'zoning', 'page ok', count(*) FROM z UNION ALL SELECT 'zoning', 'page corrupt', count(*) FROM z WHERE page_no % 3 = 0
UNION ALL SELECT 'zoning', 'feature ' || status, count(*) FROM zparsed_all GROUP BY status""", "parcels", "buildings", "raisable", "planning", "forest", "zparsed_all")
oracle("geo_dwithin", """
SELECT a.egrid, b.egrid AS other_egrid FROM parcels a JOIN parcels b
  ON a.egrid <> b.egrid AND b.xmin <= a.xmax + 0.5 AND a.xmin - 0.5 <= b.xmax AND b.ymin <= a.ymax + 0.5 AND a.ymin - 0.5 <= b.ymax
WHERE greatest(a.xmin - b.xmax, b.xmin - a.xmax, 0) ** 2 + greatest(a.ymin - b.ymax, b.ymin - a.ymax, 0) ** 2 <= 0.25""",
       "parcels")
oracle("geo_contains", """
SELECT z.zone_id, p.egrid FROM zoning z JOIN parcels p ON p.ymin >= z.ymin AND p.ymax <= z.ymax
 AND ((p.xmin >= z.p1x1 AND p.xmax <= z.p1x2) OR (z.p2x1 IS NOT NULL AND p.xmin >= z.p2x1 AND p.xmax <= z.p2x2))""",
       "zoning", "parcels")

# ---------------------------------------------------------------- 2.1 ----
oracle("src_page_status", """
WITH n AS (SELECT p // 100 AS page_no, count(*) AS n FROM zoning_src GROUP BY 1)
SELECT page_no, 'ok' AS status, n AS n_features FROM n
UNION ALL SELECT -1 - page_no, 'corrupt', 0 FROM n WHERE page_no % 3 = 0""", "zoning_src")
oracle("src_extract_status", """
SELECT 'CH' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS egrid, CASE WHEN event_id % 50 = 49 THEN 'malformed' ELSE 'ok' END AS status,
       CAST(CASE WHEN event_id % 50 = 49 THEN 0 WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_restrictions FROM events""")
proj("src_geojson_pages", "zone_id, page_no, zone_code, height_limit_m, commune_bfs, is_building_zone", "zparsed")


proj("src_bbox_read", "bld_id, floors", "bld_env")
oracle("src_feature_count", """
SELECT 'parcels' AS layer, count(*) AS n FROM parcels UNION ALL SELECT 'zoning', count(*) FROM zoning
UNION ALL SELECT 'buildings', count(*) FROM buildings UNION ALL SELECT 'forest', count(*) FROM forest
UNION ALL SELECT 'planning', count(*) FROM planning UNION ALL SELECT 'raisable', count(*) FROM raisable
UNION ALL SELECT 'restrictions', count(*) FROM restrictions""",
       "parcels", "zoning", "buildings", "forest", "planning", "raisable", "restrictions")
oracle("src_filter_fallback", """
SELECT 'D4A' AS variant, zone_id, 'filtered' AS branch FROM zoning WHERE zone_code = 'D4A'
UNION ALL SELECT 'ZZZ', zone_id, 'all' FROM zoning""", "zoning")
oracle("src_restriction_extracts", "SELECT egrid, theme_code, theme_text, sub_theme, legal_state FROM flat_extracts "
       "WHERE egrid IN (SELECT egrid FROM shortlist)", "flat_extracts", "shortlist")
proj("src_table", "egrid, commune_bfs, (xmax - xmin) * (ymax - ymin) AS area_m2", "parcels")

# ---------------------------------------------------------------- 2.2 ----
proj("snk_replace_layer", "zone_id, zone_code", "zoning")
oracle("snk_upsert_parcel", """
WITH o AS (SELECT * FROM enriched WHERE CAST(source_id AS BIGINT) % 3 <> 0),
     n AS (SELECT * FROM enriched WHERE CAST(source_id AS BIGINT) % 5 <> 0)
SELECT coalesce(o.egrid, n.egrid) AS egrid,
       CASE WHEN o.egrid IS NOT NULL THEN o.source_id ELSE 'n' || n.source_id END AS source_id,
       CASE WHEN n.egrid IS NOT NULL THEN n.commune_bfs ELSE o.commune_bfs END AS commune_bfs,
       CASE WHEN n.egrid IS NOT NULL THEN n.commune_name ELSE o.commune_name END AS commune_name,
       CASE WHEN n.egrid IS NOT NULL THEN n.parcel_no ELSE o.parcel_no END AS parcel_no,
       CASE WHEN n.egrid IS NOT NULL THEN n.area_m2 ELSE 1.0::DOUBLE END AS area_m2,
       CASE WHEN o.egrid IS NOT NULL THEN 'old-' || o.egrid ELSE 'new-' || n.egrid END AS parcel_uid,
       CASE WHEN o.egrid IS NOT NULL THEN DATE '2024-01-01' ELSE DATE '2025-01-01' END AS first_seen,
       CASE WHEN o.egrid IS NOT NULL THEN 'Zone old' END AS zone_type
FROM o FULL OUTER JOIN n ON o.egrid = n.egrid""", "enriched")
proj("snk_replace_keys", "egrid, theme_code, legal_state", "restrictions2")
oracle("join_key_list", "SELECT egrid, theme_code, legal_state FROM restrictions "
       "WHERE egrid NOT IN (SELECT egrid FROM shortlist)", "restrictions", "shortlist")
proj("content_hash", "egrid, content_hash", "cur_hash")
proj("snk_append_snapshot", "egrid, content_hash, 'run3' AS run_id", "cur_hash")
oracle("snk_append_changes", "SELECT count(*) AS n_changes FROM changes", "changes")
proj("snk_additive_migrate", "zone_id, CAST(0 AS BIGINT) AS n_buildings, 0.0::DOUBLE AS built_footprint_m2, "
     "CAST(NULL AS DOUBLE) AS avg_floors, CAST(0 AS BIGINT) AS n_raisable", "zones_a")

# ---------------------------------------------------------------- 2.5 ----
proj("join_spatial_inner", "egrid, zone_id, overlap_m2", "pz_pairs")
proj("join_spatial_sum", "egrid, forest_overlap_m2, building_footprint_m2", "enriched")
proj("join_spatial_count", "zone_id, n_raisable", "zones_b")
proj("join_zone_buildings", "zone_id, n_buildings, built_footprint_m2, built_floor_area_m2, avg_floors", "zones_b")
proj("agg_zone_buildings", "zone_id, n_buildings, built_footprint_m2, built_floor_area_m2, avg_floors", "zones_b",
     "n_buildings > 0")
oracle("join_spatial_exists", "SELECT 'parcel' AS kind, egrid AS id, in_planning_zone FROM enriched UNION ALL "
       "SELECT 'zone', zone_id, in_planning_zone FROM zones_a", "enriched", "zones_a")
proj("join_dwithin_self", "egrid", "adjacent")
oracle("join_update_from", """
SELECT p.egrid, CASE WHEN d.egrid IS NOT NULL THEN d.typ_kt ELSE 'prior' END AS zone_type,
       CASE WHEN d.egrid IS NOT NULL THEN d.hauptnutzung ELSE 'prior' END AS primary_use,
       CASE WHEN d.egrid IS NOT NULL THEN d.is_building_zone ELSE false END AS is_building_zone
FROM parcels p LEFT JOIN dominant d ON d.egrid = p.egrid""", "parcels", "dominant")
oracle("join_semi_checked", "SELECT egrid FROM parcels WHERE egrid IN (SELECT egrid FROM restrictions)",
       "parcels", "restrictions")
proj("join_exists_blocking", "egrid", "enriched", "oereb_blocking")
proj("join_left_changes", "egrid, new_hash, old_hash", "diff")

# ---------------------------------------------------------------- 2.6 ----
_CAGG = ("commune_bfs, n_building_zones, total_developable_m2, CAST(n_in_plan_revision AS BIGINT) AS n_in_plan_revision, "
         "largest_zone_m2, top_zone_score, commune_score")
proj("agg_commune_a", _CAGG, "communes_a")
proj("agg_commune_b", _CAGG, "communes_b")
proj("agg_headline_a", "commune_bfs, headline", "communes_a")
proj("agg_headline_b", "commune_bfs, headline", "communes_b")
oracle("agg_filtered_counts", """
SELECT count(*) AS n_parcels, count(*) FILTER (WHERE signal_underuse) AS n_underuse,
       count(*) FILTER (WHERE signal_servicing) AS n_servicing, count(*) FILTER (WHERE signal_assembly) AS n_assembly,
       count(*) FILTER (WHERE oereb_blocking) AS n_blocked, count(*) FILTER (WHERE oereb_checked) AS n_checked,
       sum(developable_m2) FILTER (WHERE is_building_zone) AS developable_m2 FROM scored""", "scored")
oracle("agg_count_distinct", "SELECT count(DISTINCT commune_bfs) AS n_communes FROM zones_b", "zones_b")
_MIX = (f"SELECT zone_tier, zone_code, count(*) AS n_zones, "
        f"CAST({_half_up('sum(developable_m2) / 10000.0::DOUBLE')} AS BIGINT) AS developable_ha "
        f"FROM zones_b GROUP BY zone_tier, zone_code")
oracle("agg_group_mix", _MIX, "zones_b")
oracle("order_mix", f"SELECT * FROM ({_MIX})",
       "zones_b")
ORACLE["report_zone_mix"] = ORACLE["order_mix"]
oracle("agg_run_counters", """
SELECT count(*) FILTER (WHERE opportunity_score > 0) AS n_scored,
       count(*) FILTER (WHERE zone_tier = 'target' AND utilisation_pct < 40) AS n_leads,
       count(*) FILTER (WHERE n_raisable > 0) AS n_with_raisable,
       count(DISTINCT coalesce(commune_bfs, -1)) AS n_communes FROM zones_b""", "zones_b")
oracle("agg_distinct", "SELECT DISTINCT egrid FROM restrictions", "restrictions")

# ---------------------------------------------------------- 2.7 / 2.8 ----
proj("latest_snapshot", "egrid, content_hash", "latest")
oracle("topn_shortlist", "SELECT egrid, opportunity_score, row_number() OVER (ORDER BY opportunity_score DESC, egrid) "
       "AS rank FROM shortlist", "shortlist")
oracle("topn_communes", "SELECT commune_bfs, commune_score FROM communes_b WHERE coalesce(commune_score, 0) > 0 "
       "ORDER BY commune_score DESC, commune_bfs LIMIT 15", "communes_b")
oracle("topn_leads", "SELECT zone_id, opportunity_score FROM zones_b WHERE opportunity_score > 0 AND zone_tier = 'target' "
       "ORDER BY opportunity_score DESC, zone_id LIMIT 20", "zones_b")
_TOPC = f"""
SELECT commune_bfs, commune_score, coalesce(commune_name, '(bfs ' || commune_bfs || ')') AS commune_label,
       CAST({_half_up('coalesce(commune_score, 0)')} AS BIGINT) AS score_rounded,
       coalesce(n_building_zones, 0) AS n_zones,
       CAST(CAST({_half_up('coalesce(total_developable_m2, 0) / 10000.0::DOUBLE', 1)} AS DECIMAL(38,1)) AS VARCHAR)
         AS developable_ha,
       row_number() OVER (ORDER BY commune_score DESC, commune_bfs) AS rank
FROM communes_b WHERE coalesce(commune_score, 0) > 0 ORDER BY commune_score DESC, commune_bfs LIMIT 15"""
oracle("report_top_communes", _TOPC, "communes_b")
oracle("rank_number", f"SELECT rank, commune_bfs FROM ({_TOPC})", "communes_b")

# ---------------------------------------------------------------- 2.11 ---
proj("job_detect_changes", "egrid, change_type, detail", "changes")
proj("job_restriction_refresh", "egrid, oereb_checked, oereb_blocking, signal_assembly, opportunity_score", "scored2")
proj("job_guard_empty_layer", "zone_id, opportunity_score, CAST(0 AS BIGINT) AS n_buildings", "zones_a")
oracle("report_kpis", """
SELECT count(*) AS n_zones, count(*) FILTER (WHERE opportunity_score > 0) AS n_scored,
       coalesce(CAST(round_even(sum(developable_m2) / 10000.0::DOUBLE, 0) AS BIGINT), 0) AS developable_ha,
       count(DISTINCT commune_bfs) AS n_communes FROM zones_b""", "zones_b")
_LEADS = f"""
SELECT zone_id, commune_name, zone_code, height_limit_m, opportunity_score,
       round_even(developable_m2, 0) AS developable_m2,
       CAST({_half_up('opportunity_score')} AS BIGINT) AS score_rounded,
       CAST({_half_up('utilisation_pct')} AS BIGINT) AS util_rounded,
       n_buildings, n_raisable, score_reasons,
       row_number() OVER (ORDER BY opportunity_score DESC, zone_id) AS rank
FROM zones_b WHERE opportunity_score > 0 AND zone_tier = 'target' ORDER BY opportunity_score DESC, zone_id LIMIT 20"""
oracle("report_top_leads", _LEADS, "zones_b")
oracle("report_sink", f"SELECT rank, zone_id, score_rounded, util_rounded FROM ({_LEADS})", "zones_b")
oracle("report_underuse", """
SELECT count(*) FILTER (WHERE zone_tier = 'target' AND n_buildings = 0) AS n_empty,
       count(*) FILTER (WHERE zone_tier = 'target' AND utilisation_pct < 40 AND n_buildings > 0) AS n_underbuilt,
       count(*) FILTER (WHERE zone_tier = 'target' AND utilisation_pct >= 80) AS n_full,
       CAST(coalesce(sum(n_raisable), 0) AS BIGINT) AS n_raisable FROM zones_b""", "zones_b")
oracle("report_pdf_kpis", f"""
SELECT count(*) FILTER (WHERE zone_tier = 'target') AS n_target,
       count(*) FILTER (WHERE zone_tier = 'target' AND n_buildings = 0) AS n_empty,
       count(*) FILTER (WHERE zone_tier = 'target' AND utilisation_pct < 40 AND n_buildings > 0) AS n_underbuilt,
       count(*) FILTER (WHERE zone_tier = 'target' AND utilisation_pct >= 80) AS n_full,
       CAST(coalesce(sum(n_raisable), 0) AS BIGINT) AS n_raisable,
       coalesce(CAST({_half_up("sum(developable_m2) FILTER (WHERE zone_tier = 'target') / 10000.0::DOUBLE")} AS BIGINT), 0)
         AS target_ha FROM zones_b""", "zones_b")
_U = f"CAST({_half_up('utilisation_pct')} AS BIGINT)"
oracle("report_pdf_leads", f"""
SELECT zone_id, opportunity_score, commune_name, zone_code,
       CAST({_half_up('developable_m2')} AS BIGINT) AS developable_m2,
       CASE WHEN height_limit_m IS NULL OR height_limit_m = 0 THEN '?' ELSE CAST(height_limit_m AS VARCHAR) END || ' m'
         AS height_txt,
       coalesce(CAST({_U} AS VARCHAR), '0') || '%' AS built_txt,
       {LEAD_STATUS.format(u=_U)} AS status,
       row_number() OVER (ORDER BY opportunity_score DESC, zone_id) AS rank
FROM zones_b WHERE opportunity_score > 0 AND zone_tier = 'target' ORDER BY opportunity_score DESC, zone_id LIMIT 15""",
       "zones_b")

# ---------------------------------------------------------------- 2.12 ---
oracle("prof_keys", """
SELECT DISTINCT unnest(['OBJECTID', 'ZONE', 'NOM_ZONE', 'DESCRIPTION', 'COMMUNE', 'NO_COMM_FEDERAL', 'INDICE']) AS key
FROM zoning_src
UNION SELECT DISTINCT unnest(['canton', 'affectation_principale_code', 'type_canton_designation',
                              'affectation_principale_designation', 't_id']) FROM federal""", "zoning_src", "federal")
oracle("prof_low_card", """
WITH kv AS (
  SELECT 'OBJECTID' AS key, CAST(p AS VARCHAR) AS value FROM zoning_src
  UNION ALL SELECT 'ZONE', CASE WHEN p % 9 = 0 THEN ' ' || code0 || ' ' ELSE code0 END FROM zoning_src
  UNION ALL SELECT 'NOM_ZONE', zone_name FROM zoning_src
  UNION ALL SELECT 'DESCRIPTION', coalesce(description, 'None') FROM zoning_src
  UNION ALL SELECT 'COMMUNE', coalesce(n_name, 'None') FROM zoning_src
  UNION ALL SELECT 'NO_COMM_FEDERAL', coalesce(bfs_txt, 'None') FROM zoning_src
  UNION ALL SELECT 'INDICE', CAST(p_size AS VARCHAR) FROM zoning_src)
SELECT key, value, count(*) AS n, count(*) OVER (PARTITION BY key) AS n_distinct FROM kv GROUP BY key, value""", "zoning_src")
oracle("prof_value_mix", """
SELECT kanton AS value, count(*) AS n,
       CASE WHEN kanton = 'VD' THEN (SELECT count(*) FROM pfeat WHERE k <= (SELECT min(k) FROM pfeat WHERE kanton = 'VD')) END
         AS first_pos
FROM pfeat GROUP BY kanton""", "pfeat")
oracle("prof_crs", "SELECT CASE WHEN p_partkey % 3 = 0 THEN 'WGS84' ELSE 'LV95' END AS crs, count(*) AS n FROM part "
       "GROUP BY 1")
oracle("prof_filter_works", """
SELECT 'upper' AS probe, count(*) AS n, coalesce(bool_and(kanton = 'VD'), false) AND count(*) > 0 AS only_value
FROM pfeat WHERE upper(kanton) = 'VD'
UNION ALL
SELECT 'exact', count(*), coalesce(bool_and(kanton = 'VD'), false) AND count(*) > 0 FROM pfeat WHERE kanton = 'VD'""",
       "pfeat")
oracle("prof_keyword_hits", """
SELECT page_id, concat_ws('|', CASE WHEN contains(lower(html), 'zone_affectation') THEN 'zone_affectation' END,
                                CASE WHEN contains(lower(html), 'affectation') THEN 'affectation' END,
                                CASE WHEN contains(lower(html), 'zone') THEN 'zone' END) AS hits,
       CAST((contains(lower(html), 'zone_affectation'))::INT + (contains(lower(html), 'affectation'))::INT
            + (contains(lower(html), 'zone'))::INT AS INTEGER) AS n_hits
FROM pages""")
oracle("job_parcel_runs", """
SELECT s.egrid, sha256(s.egrid) AS parcel_uid, TIMESTAMP '2025-01-01 00:00:00' AS first_seen,
       CASE WHEN CAST(e.source_id AS BIGINT) % 3 = 0 THEN TIMESTAMP '2025-01-01 00:00:00' ELSE TIMESTAMP '2025-01-02 00:00:00' END AS last_updated,
       e.source_id, e.area_m2, e.zone_type, e.primary_use, e.is_building_zone, e.developable_m2, s.opportunity_score,
       CAST(1 AS BIGINT) AS n_changes, TIMESTAMP '2025-01-01 00:00:00' AS last_change
FROM scored s JOIN enriched e ON e.egrid = s.egrid""", "scored", "enriched")
proj("stream_restriction_refresh", "egrid, theme_code, theme_text, legal_state", "restrictions2")

# ---------------------------------------------------------------- 2.10 ---
proj("scalar_null", "egrid, coalesce(oereb_blocking, false) AS blocked, nullif(commune_bfs, 6601) AS bfs_not_6601, "
     "oereb_blocking IS DISTINCT FROM false AS distinct_from_false, zone_type IS NULL AS no_zone", "enriched")
proj("scalar_conditional", "zone_id, greatest(height_limit_m, 12) AS h_at_least_12, "
     "least(utilisation_pct, 50.0::DOUBLE) AS util_capped, developable_m2 BETWEEN 1000 AND 20000 AS mid_size, "
     "zone_code IN ('D4A', 'D4B', '3') AS listed, signal_large_zone AND utilisation_pct < 40 AS large_and_low, "
     "CASE WHEN n_buildings = 0 THEN 'empty' WHEN n_buildings < 10 THEN 'few' ELSE 'many' END AS density", "zones_b")
proj("scalar_math", f"zone_id, CAST(floor(height_limit_m / 3.0::DOUBLE) AS BIGINT) AS storeys, "
     f"round_even(utilisation_pct, 0) AS util_half_even, CAST({_half_up('utilisation_pct')} AS BIGINT) AS util_half_up, "
     f"built_floor_area_m2 / developable_m2 AS floor_ratio", "zones_b")
proj("scalar_string", "zone_id, 'code ' || zone_code || density_indice AS pipe_concat, "
     "concat_ws('', 'h', CAST(height_limit_m AS VARCHAR)) AS pg_concat, "
     "trim(', ' || typ_kt || ', ,', ', ') AS trimmed, md5(zone_id) AS md5_id, upper(typ_kt) AS upper_type, "
     "regexp_matches(lower(hauptnutzung), 'nation_1[0-9]') AS teen_nation", "zoning")
proj("scalar_cast", "egrid, CAST(CAST(round_even(area_m2, 0) AS BIGINT) AS VARCHAR) AS area_text, "
     "CAST(is_building_zone AS VARCHAR) AS bz_text, TRY_CAST(parcel_no AS INTEGER) AS parcel_int, "
     "CAST(NULL AS INTEGER) AS not_an_int", "enriched")
oracle("scalar_datetime", "SELECT CAST(c_custkey AS VARCHAR) AS pz_id, DATE '2025-01-01' AS valid_from, "
       "TIMESTAMP '2025-01-03 00:00:00' AS run_ts, true AS in_force_at_run, CAST(2 AS INTEGER) AS days_in_force "
       "FROM customer")
oracle("scalar_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
       "CAST(json_object('id', event_id, 'low_value', CASE WHEN value < 20 THEN value END) AS VARCHAR) AS doc "
       "FROM events")
oracle("scalar_array_map", "SELECT CAST(p AS VARCHAR) AS zone_id, 7 AS n_keys, "
       "CASE WHEN p % 7 = 0 THEN xmin + 148 END AS second_part_xmin, "
       "CASE WHEN p % 7 = 0 THEN 0 ELSE 1 END AS n_wide_parts FROM zoning_src", "zoning_src")
