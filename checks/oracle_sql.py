"""Independent DuckDB formulation of every checked query.

The geometry layers are rebuilt here from the driver tables with plain
rectangle arithmetic (no grid, no shape structs) and the spatial relations are
brute-force range joins, so the oracle shares no algorithm with the Spark code.
Fragments are CTEs; ``sql(body, *needs)`` prepends the transitive closure.
"""

from __future__ import annotations

import re

X0, Y0 = "2500000.0::DOUBLE", "1110000.0::DOUBLE"


def ov(a: str, b: str, ax1=None, ax2=None) -> str:
    """Overlap area of rectangle a with rectangle b (optionally a's x-range overridden)."""
    ax1 = ax1 or f"{a}.xmin"
    ax2 = ax2 or f"{a}.xmax"
    return (f"(greatest(least({ax2}, {b}.xmax) - greatest({ax1}, {b}.xmin), 0)"
            f" * greatest(least({a}.ymax, {b}.ymax) - greatest({a}.ymin, {b}.ymin), 0))")


def meets(a: str, b: str, ax1=None, ax2=None) -> str:
    ax1 = ax1 or f"{a}.xmin"
    ax2 = ax2 or f"{a}.xmax"
    return (f"({ax1} <= {b}.xmax AND {b}.xmin <= {ax2}"
            f" AND {a}.ymin <= {b}.ymax AND {b}.ymin <= {a}.ymax)")


def zone_meets(z: str, r: str) -> str:
    """Closed intersection of a (possibly two-part) zone with rectangle r."""
    return (f"({meets(z, r, f'{z}.p1x1', f'{z}.p1x2')} OR ({z}.p2x1 IS NOT NULL AND "
            f"{meets(z, r, f'{z}.p2x1', f'{z}.p2x2')}))")


def zone_ov(z: str, r: str) -> str:
    return (f"({ov(z, r, f'{z}.p1x1', f'{z}.p1x2')} + CASE WHEN {z}.p2x1 IS NULL THEN 0 ELSE "
            f"{ov(z, r, f'{z}.p2x1', f'{z}.p2x2')} END)")


BBOX_JOIN = "{b}.xmin <= {a}.xmax AND {a}.xmin <= {b}.xmax AND {b}.ymin <= {a}.ymax AND {a}.ymin <= {b}.ymax"

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], body: str) -> None:
    CTE[name] = (needs, body)


# --------------------------------------------------------------------------
# layers
# --------------------------------------------------------------------------
cte("parcels", (), f"""
SELECT CAST(o_orderkey AS VARCHAR) AS source_id,
       'CH' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS egrid,
       CAST(CASE WHEN o_custkey % 25 = 24 THEN NULL ELSE 6600 + o_custkey % 25 END AS INTEGER) AS commune_bfs,
       n_name AS commune_name, CAST(o_orderkey AS VARCHAR) AS parcel_no,
       {X0} + (o_orderkey % 120) * 48 AS xmin, {Y0} + (o_orderkey // 120) * 48 AS ymin,
       {X0} + (o_orderkey % 120) * 48 + CASE o_custkey % 3 WHEN 0 THEN 48.0 WHEN 1 THEN 47.75 ELSE 40.0 END::DOUBLE AS xmax,
       {Y0} + (o_orderkey // 120) * 48 + CASE o_orderkey % 2 WHEN 0 THEN 48.0 ELSE 40.0 END::DOUBLE AS ymax
FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 25""")

cte("zoning_src", (), f"""
SELECT p_partkey AS p, p_size, p_type, n_name,
       (['D4A','D4B','D4AP','D3','D2','DAM','DIA','D5','2','3','4A','4B','5','1','','AGR'])[p_size % 16 + 1] AS code0,
       CASE WHEN p_size % 16 = 15 THEN 'Zone agricole'
            WHEN p_size % 16 = 6 AND p_partkey % 2 = 0 THEN 'Zone ferroviaire'
            ELSE 'Zone ' || p_type END AS zone_name,
       CASE p_partkey % 5 WHEN 0 THEN 'Logements (gabarit max. 21 m)' WHEN 1 THEN 'gabarit maximum 24 m'
            WHEN 2 THEN 'mixte (Gabarit max.15 m)' WHEN 3 THEN 'villas, gabarit max 10 m' END AS description,
       CASE WHEN p_partkey % 25 = 24 THEN NULL WHEN p_partkey % 13 = 0 THEN 'n/a'
            WHEN p_partkey % 11 = 0 THEN ' ' || CAST(6600 + p_partkey % 25 AS VARCHAR) || ' '
            ELSE CAST(6600 + p_partkey % 25 AS VARCHAR) END AS bfs_txt,
       {X0} + (p_partkey % 20) * 288 AS xmin, {Y0} + (p_partkey // 20) * 60 AS ymin,
       {X0} + (p_partkey % 20) * 288 + 288 AS xmax, {Y0} + (p_partkey // 20) * 60 + 60 - (p_partkey % 4) * 2 AS ymax
FROM part LEFT JOIN nation ON n_nationkey = p_partkey % 25""")

cte("zoning", ("zoning_src",), """
SELECT CAST(p AS VARCHAR) AS zone_id,
       CASE WHEN regexp_matches(trim(bfs_txt), '^[+-]?[0-9]+$') THEN CAST(trim(bfs_txt) AS INTEGER) END AS commune_bfs,
       zone_name AS typ_kt, n_name AS hauptnutzung,
       CASE WHEN regexp_matches(lower(zone_name), 'agricole|bois|forêt|foret|protégée|protegee|verdure|ferroviaire|eaux') THEN false
            WHEN upper(trim(CASE WHEN p % 9 = 0 THEN ' ' || code0 || ' ' ELSE code0 END)) = '' THEN false
            ELSE regexp_matches(upper(trim(code0)), '^[D12345]') END AS is_building_zone,
       trim(CASE WHEN p % 9 = 0 THEN ' ' || code0 || ' ' ELSE code0 END) AS zone_code,
       TRY_CAST(NULLIF(regexp_extract(description, 'gabarit\\s+max(?:imum)?\\.?\\s*(\\d{1,2})\\s*m', 1, 'i'), '') AS INTEGER) AS height_limit_m,
       CAST(p_size AS VARCHAR) AS density_indice,
       xmin, ymin, xmax, ymax,
       xmin AS p1x1, CASE WHEN p % 7 = 0 THEN xmin + 140 ELSE xmax END AS p1x2,
       CASE WHEN p % 7 = 0 THEN xmin + 148 END AS p2x1, CASE WHEN p % 7 = 0 THEN xmax END AS p2x2,
       CASE WHEN p % 7 = 0 THEN 2 ELSE 1 END AS n_parts,
       CASE WHEN p % 7 = 0 THEN 280.0 ELSE 288.0 END * (ymax - ymin) AS area_m2
FROM zoning_src""")

cte("buildings", (), f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS bld_id,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(round(l_tax * 100) AS INTEGER) END AS floors,
       {X0} + (l_orderkey % 120) * 48 + 1 + (l_linenumber - 1) * 5 AS xmin,
       {Y0} + (l_orderkey // 120) * 48 + 1 + (l_linenumber % 4) * 9 AS ymin,
       {X0} + (l_orderkey % 120) * 48 + 1 + (l_linenumber - 1) * 5
          + 2 + CAST(l_quantity AS INTEGER) % 6 + CASE WHEN l_orderkey % 4 = 0 THEN 20 ELSE 0 END AS xmax,
       {Y0} + (l_orderkey // 120) * 48 + 1 + (l_linenumber % 4) * 9
          + 2 + CAST(l_quantity AS INTEGER) % 7 + CASE WHEN l_orderkey % 4 = 0 THEN 20 ELSE 0 END AS ymax
FROM lineitem""")

cte("forest", (), f"""
SELECT CAST(s_suppkey AS VARCHAR) AS fg_id, {X0} + (s_suppkey * 97) % 5700 AS xmin, {Y0} + s_suppkey * 60 AS ymin,
       {X0} + (s_suppkey * 97) % 5700 + 60 + (s_suppkey % 4) * 20 AS xmax,
       {Y0} + s_suppkey * 60 + 60 + (s_suppkey % 4) * 20 AS ymax
FROM supplier""")

cte("planning", (), f"""
SELECT CAST(c_custkey AS VARCHAR) AS pz_id, {X0} + (c_custkey * 53) % 5600 AS xmin, {Y0} + c_custkey * 4 AS ymin,
       {X0} + (c_custkey * 53) % 5600 + 100 AS xmax, {Y0} + c_custkey * 4 + 100 AS ymax
FROM customer""")

cte("raisable", (), f"""
SELECT c_custkey AS objectid, {X0} + (c_custkey * 37) % 5750 AS xmin, {Y0} + c_custkey * 4 AS ymin,
       {X0} + (c_custkey * 37) % 5750 + 10 AS xmax, {Y0} + c_custkey * 4 + 10 AS ymax
FROM customer""")

cte("restrictions", (), """
SELECT 'CH' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS egrid,
       CASE event_type WHEN 'view' THEN 'ForestPerimeters' WHEN 'signup' THEN 'LandUsePlans'
            WHEN 'purchase' THEN 'ContaminatedSites' WHEN 'error' THEN 'NoiseSensitivityLevels'
            WHEN 'click' THEN 'GroundwaterProtectionZones' END AS theme_code,
       'Thème ' || event_type AS theme_text, CAST(NULL AS VARCHAR) AS sub_theme,
       CASE WHEN value < 20 THEN 'inForce' ELSE 'changeWithPreEffect' END AS legal_state
FROM events""")

# --------------------------------------------------------------------------
# parcel enrichment + scoring
# --------------------------------------------------------------------------
cte("pz_pairs", ("parcels", "zoning"), f"""
SELECT p.egrid, z.zone_id, z.typ_kt, z.hauptnutzung, z.is_building_zone, {zone_ov('z', 'p')} AS overlap_m2
FROM parcels p JOIN zoning z ON {BBOX_JOIN.format(a='p', b='z')} AND {zone_meets('z', 'p')}""")

cte("dominant", ("pz_pairs",), """
SELECT egrid, zone_id, typ_kt, hauptnutzung, is_building_zone, overlap_m2 FROM (
  SELECT *, row_number() OVER (PARTITION BY egrid ORDER BY overlap_m2 DESC, zone_id) AS rn FROM pz_pairs) WHERE rn = 1""")

cte("p_forest", ("parcels", "forest"), f"""
SELECT p.egrid, sum({ov('p', 'f')}) AS s FROM parcels p JOIN forest f ON {BBOX_JOIN.format(a='p', b='f')} GROUP BY p.egrid""")

cte("p_bld", ("parcels", "buildings"), f"""
SELECT p.egrid, sum({ov('p', 'b')}) AS s FROM parcels p JOIN buildings b ON {BBOX_JOIN.format(a='p', b='b')} GROUP BY p.egrid""")

cte("p_plan", ("parcels", "planning"), f"""
SELECT DISTINCT p.egrid FROM parcels p JOIN planning g ON {BBOX_JOIN.format(a='p', b='g')}""")

cte("p_flags", ("restrictions",), """
SELECT egrid, bool_or(theme_code IN ('ForestPerimeters','NoiseSensitivityLevels','ContaminatedSites','GroundwaterProtectionZones')
                      AND legal_state = 'inForce') AS blocking
FROM restrictions GROUP BY egrid""")

cte("enriched", ("parcels", "dominant", "p_forest", "p_bld", "p_plan", "p_flags"), """
SELECT p.egrid, p.source_id, p.commune_bfs, p.commune_name, p.parcel_no, p.xmin, p.ymin, p.xmax, p.ymax,
       (p.xmax - p.xmin) * (p.ymax - p.ymin) AS area_m2,
       d.typ_kt AS zone_type, d.hauptnutzung AS primary_use, d.is_building_zone, d.zone_id AS dominant_zone_id,
       pl.egrid IS NOT NULL AS in_planning_zone,
       coalesce(f.s, 0) AS forest_overlap_m2, coalesce(b.s, 0) AS building_footprint_m2,
       CASE WHEN d.is_building_zone THEN greatest((p.xmax - p.xmin) * (p.ymax - p.ymin) - coalesce(f.s, 0), 0) ELSE 0 END::DOUBLE AS developable_m2,
       CASE WHEN (p.xmax - p.xmin) * (p.ymax - p.ymin) > 0 THEN coalesce(b.s, 0) / ((p.xmax - p.xmin) * (p.ymax - p.ymin)) END AS coverage_ratio,
       r.egrid IS NOT NULL AS oereb_checked, r.blocking AS oereb_blocking
FROM parcels p LEFT JOIN dominant d ON d.egrid = p.egrid LEFT JOIN p_forest f ON f.egrid = p.egrid
LEFT JOIN p_bld b ON b.egrid = p.egrid LEFT JOIN p_plan pl ON pl.egrid = p.egrid LEFT JOIN p_flags r ON r.egrid = p.egrid""")

cte("adjacent", ("enriched",), """
SELECT DISTINCT a.egrid FROM enriched a JOIN enriched b
  ON a.primary_use = b.primary_use AND a.egrid <> b.egrid AND a.is_building_zone AND b.is_building_zone
 AND b.xmin <= a.xmax + 0.5 AND a.xmin - 0.5 <= b.xmax AND b.ymin <= a.ymax + 0.5 AND a.ymin - 0.5 <= b.ymax
WHERE greatest(a.xmin - b.xmax, b.xmin - a.xmax, 0) ** 2 + greatest(a.ymin - b.ymax, b.ymin - a.ymax, 0) ** 2 <= 0.25
  AND NOT (a.xmin <= b.xmin AND b.xmax <= a.xmax AND a.ymin <= b.ymin AND b.ymax <= a.ymax)""")

cte("signals", ("enriched", "adjacent"), """
SELECT e.*,
  coalesce(e.is_building_zone AND e.developable_m2 > 0 AND e.coverage_ratio IS NOT NULL AND e.coverage_ratio < 0.25
           AND coalesce(e.oereb_blocking, false) = false, false) AS signal_underuse,
  coalesce(e.is_building_zone AND e.developable_m2 > 0 AND coalesce(e.coverage_ratio, 0) < 0.03
           AND coalesce(e.oereb_blocking, false) = false, false) AS signal_servicing,
  coalesce(a.egrid IS NOT NULL AND e.developable_m2 > 0 AND coalesce(e.oereb_blocking, false) = false, false) AS signal_assembly
FROM enriched e LEFT JOIN adjacent a ON a.egrid = e.egrid""")

cte("scored", ("signals",), """
SELECT s.*, least(100.0::DOUBLE, greatest(0.0::DOUBLE, least(s.developable_m2, 5000.0::DOUBLE) / 5000.0::DOUBLE * 30
        + CASE WHEN s.signal_underuse THEN 25 ELSE 0 END + CASE WHEN s.signal_servicing THEN 20 ELSE 0 END
        + CASE WHEN s.signal_assembly THEN 20 ELSE 0 END + CASE WHEN s.in_planning_zone THEN 5 ELSE 0 END)) AS score_raw,
   coalesce(NOT s.is_building_zone, false) OR coalesce(s.oereb_blocking, false)
        OR coalesce(s.developable_m2, 0) = 0 AS score_zeroed,
   CASE WHEN coalesce(NOT s.is_building_zone, false) OR coalesce(s.oereb_blocking, false)
                      OR coalesce(s.developable_m2, 0) = 0 THEN 0.0::DOUBLE
   ELSE least(100.0::DOUBLE, greatest(0.0::DOUBLE, least(s.developable_m2, 5000.0::DOUBLE) / 5000.0::DOUBLE * 30
        + CASE WHEN s.signal_underuse THEN 25 ELSE 0 END + CASE WHEN s.signal_servicing THEN 20 ELSE 0 END
        + CASE WHEN s.signal_assembly THEN 20 ELSE 0 END + CASE WHEN s.in_planning_zone THEN 5 ELSE 0 END)) END
   AS opportunity_score
FROM signals s""")

# --------------------------------------------------------------------------
# zones: phase A, phase B, communes
# --------------------------------------------------------------------------
cte("zbase", ("zoning",), """
SELECT zone_id, commune_bfs, hauptnutzung AS commune_name, typ_kt AS zone_type, hauptnutzung AS primary_use,
       zone_code, height_limit_m, density_indice, xmin, ymin, xmax, ymax, p1x1, p1x2, p2x1, p2x2, n_parts, area_m2
FROM zoning WHERE is_building_zone""")

cte("z_forest", ("zbase", "forest"), f"""
SELECT z.zone_id, sum({zone_ov('z', 'f')}) AS s FROM zbase z JOIN forest f
  ON {BBOX_JOIN.format(a='z', b='f')} AND {zone_meets('z', 'f')} GROUP BY z.zone_id""")

cte("z_plan", ("zbase", "planning"), f"""
SELECT DISTINCT z.zone_id FROM zbase z JOIN planning g ON {BBOX_JOIN.format(a='z', b='g')} AND {zone_meets('z', 'g')}""")

# Tiers by code (every other code is secondary); points and texts of the zone score.
cte("tiers", (), "SELECT * FROM (VALUES ('D4A', 'target'), ('D4B', 'target'), ('1', 'avoid'), ('5', 'avoid')) AS t(code, tier)")
cte("tier_points", (), "SELECT * FROM (VALUES ('target', 50), ('secondary', 22), ('avoid', -20)) AS t(tier, points)")
cte("height_points", (), "SELECT * FROM (VALUES (12, 14, 12), (15, 20, 20), (21, 2147483647, 25)) AS t(low, high, points)")

cte("za2", ("zbase", "z_forest", "z_plan", "tiers"), """
SELECT z.*, w.forest_overlap_m2, pl.zone_id IS NOT NULL AS in_planning_zone, w.developable_m2, coalesce(t.tier, 'secondary') AS zone_tier,
       w.developable_m2 >= 3000 AND w.developable_m2 <= 30000 AS signal_large_zone, pl.zone_id IS NOT NULL AS signal_plan_revision,
       z.n_parts = 1 AND w.developable_m2 > 1000 AS signal_low_fragment
FROM zbase z
JOIN (SELECT b.zone_id, coalesce(f.s, 0) AS forest_overlap_m2, greatest(b.area_m2 - coalesce(f.s, 0), 0) AS developable_m2
      FROM zbase b LEFT JOIN z_forest f USING (zone_id)) w USING (zone_id)
LEFT JOIN z_plan pl USING (zone_id) LEFT JOIN tiers t ON t.code = z.zone_code""")

cte("za_points", ("za2", "tier_points", "height_points"), """
SELECT zone_id, CAST(sum(points) AS DOUBLE) AS points FROM (
  SELECT zone_id, points FROM za2 JOIN tier_points ON tier = zone_tier
  UNION ALL SELECT zone_id, points FROM za2 JOIN height_points ON height_limit_m BETWEEN low AND high
  UNION ALL SELECT zone_id, 8 FROM za2 WHERE height_limit_m IS NULL
  UNION ALL SELECT zone_id, 15 FROM za2 WHERE signal_large_zone
  UNION ALL SELECT zone_id, 7 FROM za2 WHERE developable_m2 >= 1000 AND developable_m2 < 3000
  UNION ALL SELECT zone_id, 5 FROM za2 WHERE signal_low_fragment
  UNION ALL SELECT zone_id, 5 FROM za2 WHERE signal_plan_revision) GROUP BY zone_id""")

cte("za_reasons", ("za2",), """
SELECT zone_id, string_agg(reason, ', ' ORDER BY k) AS reasons FROM (
  SELECT zone_id, 1 AS k, 'TARGET: mid-density apartment zone (' || zone_code || ')' AS reason FROM za2 WHERE zone_tier = 'target'
  UNION ALL SELECT zone_id, 2, 'buildable (' || zone_code || ')' FROM za2 WHERE zone_tier = 'secondary'
  UNION ALL SELECT zone_id, 3, 'villa/protected — low development potential' FROM za2 WHERE zone_tier = 'avoid'
  UNION ALL SELECT zone_id, 4, 'height limit ' || height_limit_m || 'm' FROM za2 WHERE height_limit_m IS NOT NULL
  UNION ALL SELECT zone_id, 5, 'workable site size' FROM za2 WHERE signal_large_zone
  UNION ALL SELECT zone_id, 6, 'very large (masterplan scale)' FROM za2 WHERE developable_m2 > 100000
  UNION ALL SELECT zone_id, 7, 'plan under revision' FROM za2 WHERE signal_plan_revision) GROUP BY zone_id""")

cte("zones_a", ("za2", "za_points", "za_reasons"), """
SELECT za2.*, CASE WHEN developable_m2 > 0 THEN greatest(0.0, least(100.0, coalesce(points, 0))) ELSE 0.0 END::DOUBLE AS opportunity_score,
       trim(coalesce(reasons, ''), ', ') AS score_reasons
FROM za2 LEFT JOIN za_points USING (zone_id) LEFT JOIN za_reasons USING (zone_id)""")

cte("envelope", ("zones_a",), """
SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
FROM zones_a WHERE zone_tier IN ('target', 'secondary')""")

cte("bld_env", ("buildings", "envelope"), """
SELECT b.* FROM buildings b, envelope e
WHERE b.xmin <= e.xmax AND b.xmax >= e.xmin AND b.ymin <= e.ymax AND b.ymax >= e.ymin""")

cte("z_bld", ("zones_a", "bld_env"), f"""
SELECT z.zone_id, count(*) AS n_buildings, sum({zone_ov('z', 'b')}) AS footprint,
       sum({zone_ov('z', 'b')} * coalesce(nullif(b.floors, 0), 2)) AS floor_area,
       avg(nullif(b.floors, 0)) AS avg_floors
FROM zones_a z JOIN bld_env b ON {BBOX_JOIN.format(a='z', b='b')} AND {zone_meets('z', 'b')} GROUP BY z.zone_id""")

cte("z_rais", ("zones_a", "raisable"), f"""
SELECT z.zone_id, count(*) AS n FROM zones_a z JOIN raisable s
  ON {BBOX_JOIN.format(a='z', b='s')} AND {zone_meets('z', 's')} GROUP BY z.zone_id""")

cte("zb1", ("zones_a", "z_bld", "z_rais"), """
SELECT z.*, coalesce(b.n_buildings, 0) AS n_buildings, coalesce(b.footprint, 0) AS built_footprint_m2,
       coalesce(b.floor_area, 0) AS built_floor_area_m2, b.avg_floors, coalesce(r.n, 0) AS n_raisable,
       CASE WHEN z.developable_m2 > 0 AND z.height_limit_m IS NOT NULL
              THEN z.developable_m2 * 0.35::DOUBLE * greatest(floor(z.height_limit_m / 3.0::DOUBLE), 1)
            WHEN z.developable_m2 > 0 THEN z.developable_m2 * 0.35::DOUBLE * 3 END AS permitted_floor_m2
FROM zones_a z LEFT JOIN z_bld b ON b.zone_id = z.zone_id LEFT JOIN z_rais r ON r.zone_id = z.zone_id""")

cte("zb2", ("zb1",), """
SELECT *, CASE WHEN coalesce(permitted_floor_m2, 0) > 0
                 THEN least(100.0::DOUBLE, 100.0::DOUBLE * built_floor_area_m2 / permitted_floor_m2) END AS utilisation_pct,
          CASE WHEN coalesce(developable_m2, 0) > 0
                 THEN least(100.0::DOUBLE, 100.0::DOUBLE * built_footprint_m2 / developable_m2) END AS coverage_pct
FROM zb1""")

cte("zb3", ("zb2",), """
SELECT *, greatest(0.0::DOUBLE, least(100.0::DOUBLE,
          (CASE WHEN utilisation_pct IS NULL THEN 35.0::DOUBLE ELSE 0.70::DOUBLE * (100.0::DOUBLE - utilisation_pct) END)
        + (CASE WHEN n_raisable > 0 THEN least(30, n_raisable * 10) ELSE 0 END))) AS underuse_score
FROM zb2""")

cte("zb_reasons", ("zb3",), """
SELECT zone_id, string_agg(reason, ', ' ORDER BY k) AS reasons FROM (
  SELECT zone_id, 1 AS k, word || zone_code AS reason FROM zb3 JOIN (VALUES ('target', 'TARGET '), ('secondary', 'buildable ')) AS t(tier, word) ON tier = zone_tier
  UNION ALL SELECT zone_id, 2, 'villa/protected' FROM zb3 WHERE zone_tier = 'avoid'
  UNION ALL SELECT zone_id, 3, 'EMPTY — no buildings on site' FROM zb3 WHERE n_buildings = 0 AND developable_m2 > 0
  UNION ALL SELECT zone_id, 4, 'only ' || CAST(CAST(round(CAST(utilisation_pct AS DECIMAL(38,10)), 0) AS DECIMAL(38,0)) AS VARCHAR) || '% of permitted density built'
            FROM zb3 WHERE utilisation_pct IS NOT NULL AND n_buildings > 0
  UNION ALL SELECT zone_id, 5, n_raisable || ' building(s) the canton says CAN BE RAISED' FROM zb3 WHERE n_raisable > 0
  UNION ALL SELECT zone_id, 6, 'height limit ' || height_limit_m || 'm' FROM zb3 WHERE height_limit_m IS NOT NULL
  UNION ALL SELECT zone_id, 7, 'workable site size' FROM zb3 WHERE signal_large_zone) GROUP BY zone_id""")

cte("zb_blend", ("zb3",), """
SELECT zone_id, greatest(0.0::DOUBLE, least(100.0::DOUBLE, 0.55::DOUBLE * opportunity_score + 0.45::DOUBLE * coalesce(underuse_score, 35.0::DOUBLE))) AS blended
FROM zb3 WHERE zone_tier <> 'avoid'""")

cte("zones_b", ("zb3", "zb_reasons", "zb_blend"), """
SELECT zb3.* REPLACE (coalesce(blended, opportunity_score) AS opportunity_score, trim(coalesce(reasons, ''), ', ') AS score_reasons)
FROM zb3 LEFT JOIN zb_blend USING (zone_id) LEFT JOIN zb_reasons USING (zone_id)""")


def _communes(src: str, phase: str) -> str:
    w_top, w_n = ("0.55", "0.30") if phase == "a" else ("0.60", "0.25")
    third = ("count(*) FILTER (WHERE in_planning_zone)" if phase == "a"
             else "coalesce(sum(n_raisable), 0)")
    ha = ("CAST(CAST(round(CAST(coalesce(total_developable_m2, 0) / 10000.0::DOUBLE AS DECIMAL(38,10)), 1)"
          " AS DECIMAL(38,1)) AS VARCHAR)")
    head = (f"n_building_zones || ' target (D4A/D4B) zones, ' || {ha} || ' ha'" if phase == "a" else
            f"n_building_zones || ' target zones, ' || {ha} || ' ha' || CASE WHEN n_in_plan_revision > 0"
            f" THEN ', ' || n_in_plan_revision || ' raisable buildings' ELSE '' END")
    return f"""
SELECT commune_bfs, commune_name, n_building_zones, total_developable_m2, n_in_plan_revision, largest_zone_m2,
       top_zone_score, CASE WHEN n_building_zones = 0 THEN 0.0::DOUBLE ELSE commune_score END AS commune_score,
       {head} AS headline
FROM (SELECT coalesce(commune_bfs, -1) AS commune_bfs, max(commune_name) AS commune_name,
             count(*) FILTER (WHERE zone_tier = 'target') AS n_building_zones,
             sum(developable_m2) FILTER (WHERE zone_tier = 'target') AS total_developable_m2,
             {third} AS n_in_plan_revision,
             max(developable_m2) FILTER (WHERE zone_tier = 'target') AS largest_zone_m2,
             max(opportunity_score) AS top_zone_score,
             least(100.0::DOUBLE, {w_top}::DOUBLE * coalesce(max(opportunity_score) FILTER (WHERE zone_tier = 'target'), 0)
               + {w_n}::DOUBLE * least(100.0::DOUBLE, count(*) FILTER (WHERE zone_tier = 'target') * 8.0::DOUBLE)
               + 0.15::DOUBLE * least(100.0::DOUBLE, coalesce(sum(developable_m2) FILTER (WHERE zone_tier = 'target'), 0) / 3000.0::DOUBLE))
               AS commune_score
      FROM {src} GROUP BY coalesce(commune_bfs, -1))"""


cte("communes_a", ("zones_a",), _communes("zones_a", "a"))
cte("communes_b", ("zones_b",), _communes("zones_b", "b"))


# --------------------------------------------------------------------------
# shortlist, change detection
# --------------------------------------------------------------------------
cte("shortlist", ("scored",), """
SELECT egrid, opportunity_score FROM scored WHERE egrid IS NOT NULL AND opportunity_score > 0
ORDER BY opportunity_score DESC, egrid LIMIT 100""")

cte("cur_hash", ("scored",), """
SELECT egrid, CAST(source_id AS BIGINT) AS k,
       md5(coalesce(zone_type, '') || '|' || coalesce(CAST(is_building_zone AS VARCHAR), '') || '|'
           || coalesce(CAST(CAST(round_even(area_m2, 0) AS BIGINT) AS VARCHAR), '') || '|'
           || coalesce(CAST(oereb_blocking AS VARCHAR), '') || '|'
           || coalesce(CAST(CAST(round_even(opportunity_score, 0) AS BIGINT) AS VARCHAR), '')) AS content_hash
FROM scored WHERE egrid IS NOT NULL""")

cte("snapshots", ("cur_hash",), """
SELECT egrid, TIMESTAMP '2025-01-01 00:00:00' AS run_ts, md5('old') AS content_hash FROM cur_hash WHERE k % 10 <> 9
UNION ALL
SELECT egrid, TIMESTAMP '2025-01-02 00:00:00', CASE WHEN k % 7 = 0 THEN md5('x') ELSE content_hash END
FROM cur_hash WHERE k % 10 <> 9""")

cte("latest", ("snapshots",), "SELECT egrid, arg_max(content_hash, run_ts) AS content_hash FROM snapshots GROUP BY egrid")

cte("diff", ("cur_hash", "latest"), """
SELECT c.egrid, c.content_hash AS new_hash, l.content_hash AS old_hash, l.egrid IS NOT NULL AS seen
FROM cur_hash c LEFT JOIN latest l ON l.egrid = c.egrid WHERE c.content_hash IS DISTINCT FROM l.content_hash""")

cte("changes", ("diff",), """
SELECT egrid, CASE WHEN seen THEN 'changed' ELSE 'new' END AS change_type,
       CAST(json_object('new_hash', new_hash, 'old_hash', old_hash) AS VARCHAR) AS detail FROM diff""")

# --------------------------------------------------------------------------
# parsed GeoJSON zoning (what the landed pages should read back as)
# --------------------------------------------------------------------------
_FORMS = {19: "flat", 17: "open", 29: "bow", 31: "empty", 37: "again", 41: "slit", 43: "twice", 47: "ell", 53: "holed", 23: "coll"}
cte("zparsed_all", ("zoning",), f"""
SELECT *, CASE WHEN form IN ('flat', 'empty') THEN 'rejected' WHEN form IN ('open', 'bow', 'again', 'slit', 'twice') THEN 'repaired' ELSE 'ok' END AS status,
       CASE form WHEN 'flat' THEN 'zero-area ring' WHEN 'empty' THEN 'no polygon' END AS reason,
       CASE WHEN form = 'coll' THEN 'GeometryCollection' WHEN form = 'whole' AND n_parts = 2 THEN 'MultiPolygon' ELSE 'Polygon' END AS gtype
FROM (SELECT z.*, CAST(zone_id AS BIGINT) // 100 AS page_no,
        CASE {" ".join(f"WHEN CAST(zone_id AS BIGINT) % {n} = 0 THEN '{f}'" for n, f in _FORMS.items())} ELSE 'whole' END AS form FROM zoning z)""")

# A form's area as signed rectangles (L-shape, hole), or as the band of half height h around the middle, h linear on each piece (crossing rings).
cte("zparsed", ("zparsed_all",), """
SELECT *, CASE form WHEN 'bow' THEN [{'a': 0.0, 'b': 0.5, 'ha': 1.0, 'hb': 0.0}, {'a': 0.5, 'b': 1.0, 'ha': 0.0, 'hb': 1.0}]
       WHEN 'twice' THEN [{'a': 0.0, 'b': 0.25, 'ha': 1.0, 'hb': 0.0}, {'a': 0.25, 'b': 0.5, 'ha': 0.0, 'hb': 1.0},
                          {'a': 0.5, 'b': 0.75, 'ha': 1.0, 'hb': 0.0}, {'a': 0.75, 'b': 1.0, 'ha': 0.0, 'hb': 1.0}] END AS band
FROM (SELECT zone_id, page_no, gtype, zone_code, height_limit_m, density_indice, commune_bfs, typ_kt, hauptnutzung, is_building_zone, form, ymin, ymax, xmin,
       CASE WHEN form IN ('whole', 'coll') THEN xmax ELSE p1x2 END AS xmax, p1x1, p1x2,
       CASE WHEN form IN ('whole', 'coll') THEN p2x1 END AS p2x1, CASE WHEN form IN ('whole', 'coll') THEN p2x2 END AS p2x2,
       CASE WHEN form IN ('whole', 'coll') THEN n_parts WHEN form = 'bow' THEN 2 WHEN form = 'twice' THEN 3 ELSE 1 END AS n_parts,
       CASE WHEN form IN ('whole', 'coll') THEN area_m2 ELSE (p1x2 - p1x1) * (ymax - ymin) * CASE WHEN form IN ('bow', 'twice') THEN 0.5::DOUBLE WHEN form IN ('ell', 'holed') THEN 0.75 ELSE 1 END END AS area_m2
      FROM zparsed_all WHERE status <> 'rejected')""")

def form_pairs(layer: str, key: str) -> str:
    """A layer of rectangles against parsed zones of every form: key, zone_id and common area of those that meet (closed)."""
    return f"""
WITH c AS (SELECT p.{key}, z.zone_id, z.form, p.xmin AS px1, p.ymin AS py1, p.xmax AS px2, p.ymax AS py2, z.p1x1 AS x1, z.p1x2 AS x2, z.ymin AS y1, z.ymax AS y2,
    (z.ymin + z.ymax) / 2 AS ym, (z.ymax - z.ymin) / 2 AS half, z.band, {zone_meets('z', 'p')} AS box_meets, {zone_ov('z', 'p')} AS box_area
  FROM {layer} p JOIN zparsed z ON {BBOX_JOIN.format(a='p', b='z')}),
b AS (SELECT {key}, zone_id, px1, px2, py1, py2, ym, x1 + (x2 - x1) * t.a AS a, x1 + (x2 - x1) * t.b AS b, half * t.ha AS ha, half * t.hb AS hb FROM (SELECT *, unnest(band) AS t FROM c WHERE band IS NOT NULL)),
e AS (SELECT *, greatest(a, px1) AS lo, least(b, px2) AS hi FROM b WHERE greatest(a, px1) <= least(b, px2)),
k AS (SELECT *, list_sort([lo, hi, least(greatest(a + (abs(py1 - ym) - ha) / (hb - ha) * (b - a), lo), hi), least(greatest(a + (abs(py2 - ym) - ha) / (hb - ha) * (b - a), lo), hi)]) AS xs,
    greatest(ha * (b - a) + (hb - ha) * (lo - a), ha * (b - a) + (hb - ha) * (hi - a)) >= greatest(py1 - ym, ym - py2) * (b - a) AS hit FROM e),
h AS (SELECT *, list_transform(xs, lambda x: greatest(least(py2, ym + ha + (hb - ha) * (x - a) / (b - a)) - greatest(py1, ym - ha - (hb - ha) * (x - a) / (b - a)), 0)) AS g FROM k),
w AS (SELECT {key}, zone_id, bool_or(hit) AS hit, sum(list_sum(list_transform([1, 2, 3], lambda i: (xs[i + 1] - xs[i]) * (g[i] + g[i + 1]) / 2))) AS area FROM h GROUP BY ALL),
q AS (SELECT *, (x1 + x2) / 2 AS xm, x1 + (x2 - x1) / 4 AS hx1, x1 + (x2 - x1) * 3 / 4 AS hx2, y1 + (y2 - y1) / 4 AS hy1, y1 + (y2 - y1) * 3 / 4 AS hy2 FROM c WHERE form IN ('ell', 'holed'))
SELECT {key}, zone_id, box_area AS overlap_m2 FROM c WHERE form NOT IN ('bow', 'twice', 'ell', 'holed') AND box_meets
UNION ALL SELECT {key}, zone_id, area FROM w WHERE hit
UNION ALL SELECT {key}, zone_id, greatest(least(x2, px2) - greatest(x1, px1), 0) * greatest(least(ym, py2) - greatest(y1, py1), 0) + greatest(least(xm, px2) - greatest(x1, px1), 0) * greatest(least(y2, py2) - greatest(ym, py1), 0)
  FROM q WHERE form = 'ell' AND (py1 <= ym OR px1 <= xm)
UNION ALL SELECT {key}, zone_id, box_area - greatest(least(hx2, px2) - greatest(hx1, px1), 0) * greatest(least(hy2, py2) - greatest(hy1, py1), 0)
  FROM q WHERE form = 'holed' AND NOT (px1 > hx1 AND px2 < hx2 AND py1 > hy1 AND py2 < hy2)"""


cte("zone_parcel", ("parcels", "zparsed"), form_pairs("parcels", "egrid"))

# --------------------------------------------------------------------------
# loader inputs (feature property rules) and extracts
# --------------------------------------------------------------------------
cte("federal", (), """
SELECT p_partkey AS p, CAST(p_partkey AS VARCHAR) AS t_id,
       CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 'f' || CAST(p_partkey AS VARCHAR) END AS fid,
       (['VD','vd','GE','FR'])[p_partkey % 4 + 1] AS canton,
       ([ '11', '21', '15', ' 43 ', 'abc', NULL])[p_partkey % 6 + 1] AS code,
       ([NULL, '', 'Zone mixte', 'Zone agricole', 'Zone centrale'])[p_partkey % 5 + 1] AS label,
       (['Zones d''habitation', 'Zones agricoles', 'Zones mixtes'])[p_partkey % 3 + 1] AS designation
FROM part""")

cte("pfeat", (), """
SELECT o_orderkey AS k, (['VD','vd','GE',NULL])[o_custkey % 4 + 1] AS kanton,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS fid0,
       'NB' || CAST(o_orderkey AS VARCHAR) AS nbident,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN ''
            ELSE 'CH' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') END AS egris,
       o_totalprice
FROM orders""")

cte("flat_extracts", (), """
SELECT 'CH' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS egrid,
       CASE event_type WHEN 'view' THEN 'ForestPerimeters' WHEN 'signup' THEN 'LandUsePlans'
            WHEN 'purchase' THEN 'ContaminatedSites' WHEN 'error' THEN 'NoiseSensitivityLevels'
            WHEN 'click' THEN 'GroundwaterProtectionZones' END
         || CASE WHEN event_id % 4 = 0 THEN '.sub' ELSE '' END AS theme_code,
       CASE WHEN event_id % 3 = 0 THEN 'Thème ' || event_type WHEN event_id % 7 = 0 THEN 'Thema ' || event_type
            ELSE 'Thème ' || event_type END AS theme_text,
       CAST(NULL AS VARCHAR) AS sub_theme,
       CASE WHEN value < 20 THEN 'inForce' ELSE 'changeWithPreEffect' END AS legal_state
FROM events WHERE event_id % 50 <> 49
UNION ALL
SELECT 'CH' || lpad(CAST(event_id AS VARCHAR), 12, '0'), 'LandUsePlans', 'Plan', 'zone', 'inForce'
FROM events WHERE event_id % 2 = 0""")

cte("restrictions2", ("restrictions", "flat_extracts", "shortlist"), """
SELECT egrid, theme_code, theme_text, sub_theme, legal_state FROM restrictions WHERE egrid NOT IN (SELECT egrid FROM shortlist)
UNION ALL
SELECT egrid, theme_code, theme_text, sub_theme, legal_state FROM flat_extracts WHERE egrid IN (SELECT egrid FROM shortlist)""")


def _variant(name: str, base: str, subs: dict[str, str], needs: tuple[str, ...]) -> None:
    body = CTE[base][1]
    for a, b in subs.items():
        body = body.replace(a, b)
    CTE[name] = (needs, body)


_variant("p_flags2", "p_flags", {"FROM restrictions": "FROM restrictions2"}, ("restrictions2",))
_variant("enriched2", "enriched", {"LEFT JOIN p_flags r": "LEFT JOIN p_flags2 r"},
         ("parcels", "dominant", "p_forest", "p_bld", "p_plan", "p_flags2"))
_variant("signals2", "signals", {"FROM enriched e": "FROM enriched2 e"}, ("enriched2", "adjacent"))
_variant("scored2", "scored", {"FROM signals s": "FROM signals2 s"}, ("signals2",))


# --------------------------------------------------------------------------
# both products from landed documents: the same rules over parsed zones and extracts
# --------------------------------------------------------------------------
# building ids repeat: rows are numbered by their values, equal rows being interchangeable
cte("bld_rows", ("buildings",), "SELECT *, row_number() OVER (ORDER BY bld_id, floors, xmin, ymin, xmax, ymax) AS bld_row FROM buildings")
for _layer, _key in (("forest", "fg_id"), ("planning", "pz_id"), ("bld_rows", "bld_row"), ("raisable", "objectid")):
    cte(f"zone_{_layer}", (_layer, "zparsed"), form_pairs(_layer, _key))
_OWN = {
    "zbase": (("zparsed",), CTE["zbase"][1].replace("FROM zoning", "FROM zparsed")),
    "z_forest": (("zone_forest",), "SELECT zone_id, sum(overlap_m2) AS s FROM zone_forest GROUP BY zone_id"),
    "z_plan": (("zone_planning",), "SELECT DISTINCT zone_id FROM zone_planning"),
    "z_bld": (("zone_bld_rows", "bld_rows", "envelope"), """
SELECT p.zone_id, count(*) AS n_buildings, sum(p.overlap_m2) AS footprint, sum(p.overlap_m2 * coalesce(nullif(b.floors, 0), 2)) AS floor_area, avg(nullif(b.floors, 0)) AS avg_floors
FROM zone_bld_rows p JOIN bld_rows b USING (bld_row) JOIN envelope e ON b.xmin <= e.xmax AND b.xmax >= e.xmin AND b.ymin <= e.ymax AND b.ymax >= e.ymin GROUP BY p.zone_id"""),
    "z_rais": (("zone_raisable",), "SELECT zone_id, count(*) AS n FROM zone_raisable GROUP BY zone_id"),
    "pz_pairs": (("zone_parcel", "zparsed"), "SELECT p.egrid, zone_id, z.typ_kt, z.hauptnutzung, z.is_building_zone, p.overlap_m2 FROM zone_parcel p JOIN zparsed z USING (zone_id)"),
    "p_flags": (("flat_extracts",), CTE["p_flags"][1].replace("FROM restrictions", "FROM flat_extracts")),
}
_CHAIN = ["zbase", "z_forest", "z_plan", "za2", "za_points", "za_reasons", "zones_a", "envelope", "z_bld", "z_rais", "zb1", "zb2", "zb3", "zb_reasons", "zb_blend", "zones_b",
          "pz_pairs", "dominant", "p_flags", "enriched", "adjacent", "signals", "scored"]
for _name in _CHAIN:
    _needs, _body = _OWN.get(_name, CTE[_name])
    _renamed = lambda text: re.sub(r"\b(" + "|".join(_CHAIN) + r")\b", r"landed_\1", text)
    cte(f"landed_{_name}", tuple(map(_renamed, _needs)), _renamed(_body))


def sql(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for m in CTE[n][0]:
            visit(m)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    head = "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order)
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return head + ",\n" + b[4:]
    return head + "\n" + body
