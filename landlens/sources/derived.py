"""Geometry layers that Spark derives from the driver tables.

The driver tables carry no geometry, so each land layer is a deterministic
function of one table (documented in FIXTURES.md section 2). Coordinates are
multiples of 0.25 m below 2^22, so every area, overlap and sum is an exact
double and independent of summation order; an SQL oracle can reproduce them
with plain rectangle arithmetic. Every layer grows with its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G

X0 = 2500000.0
Y0 = 1110000.0

# zone code by p_size % 16 (fixed layout of the derived zoning layer)
ZONE_CODES = ("D4A", "D4B", "D4AP", "D3", "D2", "DAM", "DIA", "D5",
              "2", "3", "4A", "4B", "5", "1", "", "AGR")
# planning description by p_partkey % 5 (None = no description)
DESCRIPTIONS = ("Logements (gabarit max. 21 m)", "gabarit maximum 24 m",
                "mixte (Gabarit max.15 m)", "villas, gabarit max 10 m", None)
# restriction theme by event_type
THEME_BY_EVENT = {"view": "ForestPerimeters", "signup": "LandUsePlans",
                  "purchase": "ContaminatedSites", "error": "NoiseSensitivityLevels",
                  "click": "GroundwaterProtectionZones"}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly: a scan of a small file is one task, however much is computed from a row."""
    return df.repartition(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _pick(idx, values) -> F.Column:
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        out = F.when(idx == i, lit) if out is None else out.when(idx == i, lit)
    return out


def _rect(xmin, ymin, xmax, ymax) -> F.Column:
    return F.struct(xmin.cast("double").alias("xmin"), ymin.cast("double").alias("ymin"),
                    xmax.cast("double").alias("xmax"), ymax.cast("double").alias("ymax"))


def parcels(spark: SparkSession, d: str) -> DataFrame:
    """raw.parcels: one rectangle per order on a 120-wide lattice of 48 m cells."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    xmin = F.lit(X0) + (k % 120) * 48
    ymin = F.lit(Y0) + F.expr("o_orderkey div 120") * 48
    w = F.when(c % 3 == 0, 48.0).when(c % 3 == 1, 47.75).otherwise(40.0)
    h = F.when(k % 2 == 0, 48.0).otherwise(40.0)
    df = (o.join(n, (c % 25).cast("int") == F.col("n_nationkey"), "left")
          .select(k.cast("string").alias("source_id"),
                  F.concat(F.lit("CH"), F.lpad(k.cast("string"), 12, "0")).alias("egrid"),
                  F.when(c % 25 == 24, None).otherwise(6600 + c % 25).cast("int").alias("commune_bfs"),
                  F.col("n_name").alias("commune_name"),
                  k.cast("string").alias("parcel_no"),
                  (w * h).alias("area_m2"),
                  xmin.alias("_x"), ymin.alias("_y"), w.alias("_w"), h.alias("_h")))
    return G.mark_rect_only(df.withColumn("shape", G.shape_from_box("_x", "_y", "_x + _w", "_y + _h"))
                            .drop("_x", "_y", "_w", "_h"))


def zoning_features(spark: SparkSession, d: str) -> DataFrame:
    """Cantonal zoning features (id, properties map, rects) from ``part``.

    Values are deliberately untidy where the loader must clean them: padded
    zone codes, padded or non-numeric commune numbers.
    """
    p = spread(table(spark, d, "part").select("p_partkey", "p_size", "p_type"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    k, sz = F.col("p_partkey"), F.col("p_size")
    code = _pick(sz % 16, ZONE_CODES)
    code = F.when(k % 9 == 0, F.concat(F.lit(" "), code, F.lit(" "))).otherwise(code)
    name = (F.when(sz % 16 == 15, "Zone agricole")
            .when((sz % 16 == 6) & (k % 2 == 0), "Zone ferroviaire")
            .otherwise(F.concat(F.lit("Zone "), F.col("p_type"))))
    bfs = (F.when(k % 25 == 24, F.lit(None).cast("string"))
           .when(k % 13 == 0, "n/a")
           .when(k % 11 == 0, F.concat(F.lit(" "), (6600 + k % 25).cast("string"), F.lit(" ")))
           .otherwise((6600 + k % 25).cast("string")))
    props = F.create_map(
        F.lit("OBJECTID"), k.cast("string"), F.lit("ZONE"), code, F.lit("NOM_ZONE"), name,
        F.lit("DESCRIPTION"), _pick(k % 5, DESCRIPTIONS), F.lit("COMMUNE"), F.col("n_name"),
        F.lit("NO_COMM_FEDERAL"), bfs, F.lit("INDICE"), sz.cast("string"))
    xmin = F.lit(X0) + (k % 20) * 288
    ymin = F.lit(Y0) + F.expr("p_partkey div 20") * 60
    ymax = ymin + 60 - (k % 4) * 2
    one = F.array(_rect(xmin, ymin, xmin + 288, ymax))
    two = F.array(_rect(xmin, ymin, xmin + 140, ymax), _rect(xmin + 148, ymin, xmin + 288, ymax))
    return (p.join(n, (k % 25).cast("int") == F.col("n_nationkey"), "left")
            .select(k.cast("string").alias("id"), props.alias("properties"),
                    F.when(k % 7 == 0, two).otherwise(one).alias("rects")))


def buildings(spark: SparkSession, d: str) -> DataFrame:
    """raw.buildings_ge: footprints from lineitem, placed inside their order's parcel cell."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag")
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    q = F.col("l_quantity").cast("int")
    big = F.when(k % 4 == 0, 20).otherwise(0)
    xmin = F.lit(X0) + (k % 120) * 48 + 1 + (ln - 1) * 5
    ymin = F.lit(Y0) + F.expr("l_orderkey div 120") * 48 + 1 + (ln % 4) * 9
    w, h = 2 + q % 6 + big, 2 + q % 7 + big
    return G.mark_rect_only(li
            .select(F.concat_ws("-", k.cast("string"), ln.cast("string")).alias("bld_id"),
                    F.when(F.col("l_returnflag") == "R", None)
                    .otherwise(F.round(F.col("l_tax") * 100)).cast("int").alias("floors"),
                    (w * h).cast("double").alias("footprint_m2"),
                    xmin.alias("_x"), ymin.alias("_y"), w.alias("_w"), h.alias("_h"))
            .withColumn("shape", G.shape_from_box("_x", "_y", "_x + _w", "_y + _h"))
            .drop("_x", "_y", "_w", "_h"))


def forest(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    side = 60 + (k % 4) * 20
    return G.mark_rect_only(s.select(k.cast("string").alias("fg_id"),
                     (F.lit(X0) + (k * 97) % 5700).alias("_x"), (F.lit(Y0) + k * 60).alias("_y"),
                     side.alias("_s"))
            .withColumn("shape", G.shape_from_box("_x", "_y", "_x + _s", "_y + _s"))
            .drop("_x", "_y", "_s"))


def planning_zones(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return G.mark_rect_only(c
            .select(k.cast("string").alias("pz_id"), (6600 + k % 25).cast("int").alias("commune_bfs"),
                    F.lit("inForce").alias("status"), F.lit("2025-01-01").cast("date").alias("valid_from"),
                    (F.lit(X0) + (k * 53) % 5600).alias("_x"), (F.lit(Y0) + k * 4).alias("_y"))
            .withColumn("shape", G.shape_from_box("_x", "_y", "_x + 100", "_y + 100"))
            .drop("_x", "_y"))


def surelevation(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    return G.mark_rect_only(c
            .select(k.alias("objectid"), k.cast("string").alias("egid"),
                    F.concat(F.lit("NATION_"), (k % 25).cast("string")).alias("commune"),
                    F.col("c_mktsegment").alias("destination"), F.lit(None).cast("string").alias("remarque"),
                    (F.lit(X0) + (k * 37) % 5750).alias("_x"), (F.lit(Y0) + k * 4).alias("_y"))
            .withColumn("shape", G.shape_from_box("_x", "_y", "_x + 10", "_y + 10"))
            .drop("_x", "_y"))


def restrictions(spark: SparkSession, d: str) -> DataFrame:
    """raw.oereb_restrictions, one per event."""
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    k = F.col("event_id")
    theme = None
    for ev, th in THEME_BY_EVENT.items():
        theme = (F.when(F.col("event_type") == ev, th) if theme is None
                 else theme.when(F.col("event_type") == ev, th))
    return (e
            .select(F.concat(F.lit("CH"), F.lpad(k.cast("string"), 12, "0")).alias("egrid"),
                    theme.alias("theme_code"),
                    F.concat(F.lit("Thème "), F.col("event_type")).alias("theme_text"),
                    F.lit(None).cast("string").alias("sub_theme"),
                    F.when(F.col("value") < 20, "inForce").otherwise("changeWithPreEffect").alias("legal_state")))


# ---------------------------------------------------------------------------
# landed feature sets for the loaders (id, properties, shape)
# ---------------------------------------------------------------------------

def _box_shape(df: DataFrame, x, y, w, h) -> DataFrame:
    return G.mark_rect_only(df.withColumn("_x", x).withColumn("_y", y).withColumn("_w", w)
                            .withColumn("_h", h)
                            .withColumn("shape", G.shape_from_box("_x", "_y", "_x + _w", "_y + _h"))
                            .drop("_x", "_y", "_w", "_h"))


def federal_zoning_features(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey")
    k = F.col("p_partkey")
    props = F.create_map(
        F.lit("canton"), _pick(k % 4, ("VD", "vd", "GE", "FR")),
        F.lit("affectation_principale_code"), _pick(k % 6, ("11", "21", "15", " 43 ", "abc", None)),
        F.lit("type_canton_designation"), _pick(k % 5, (None, "", "Zone mixte", "Zone agricole", "Zone centrale")),
        F.lit("affectation_principale_designation"),
        _pick(k % 3, ("Zones d'habitation", "Zones agricoles", "Zones mixtes")),
        F.lit("t_id"), k.cast("string"))
    df = p.select(F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("f"), k.cast("string")))
                  .alias("id"), props.alias("properties"), k.alias("_k"))
    return _box_shape(df, F.lit(X0) + (F.col("_k") % 20) * 288, F.lit(Y0) + F.expr("_k div 20") * 60,
                      F.lit(288.0), F.lit(60.0)).drop("_k")


def parcel_features(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    egrid = (F.when(k % 6 == 0, F.lit(None).cast("string")).when(k % 6 == 1, F.lit(""))
             .otherwise(F.concat(F.lit("CH"), F.lpad(k.cast("string"), 12, "0"))))
    props = F.create_map(
        F.lit("Kanton"), _pick(c % 4, ("VD", "vd", "GE", None)), F.lit("EGRIS_EGRID"), egrid,
        F.lit("Nummer"), (k % 1000).cast("string"), F.lit("NBIdent"), F.concat(F.lit("NB"), k.cast("string")),
        F.lit("BFSNr"), F.when(k % 5 == 0, F.lit("x")).otherwise((6600 + k % 25).cast("string")),
        F.lit("Flaeche"), F.round(F.col("o_totalprice")).cast("bigint").cast("string"))
    df = o.select(F.when(k % 8 == 0, F.lit(None).cast("string")).otherwise(k.cast("string")).alias("id"),
                  props.alias("properties"), k.alias("_k"))
    return _box_shape(df, F.lit(X0) + (F.col("_k") % 120) * 48, F.lit(Y0) + F.expr("_k div 120") * 48,
                      F.lit(48.0), F.lit(48.0)).drop("_k")


def landcover_features(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    props = F.create_map(
        F.lit("art"), _pick(ln % 5, ("Gebaeude", None, "", "Strasse", "bâtiment")),
        F.lit("objektart"), _pick(F.col("l_partkey") % 3, ("building", "Gebäude", "wasser")),
        F.lit("genre"), F.lit(None).cast("string"),
        F.lit("type"), F.when(F.col("l_suppkey") % 7 == 0, F.lit("edificio")))
    df = li.select(F.concat_ws("-", k.cast("string"), ln.cast("string")).alias("id"),
                   props.alias("properties"), k.alias("_k"), ln.alias("_l"))
    return _box_shape(df, F.lit(X0) + (F.col("_k") % 120) * 48 + F.col("_l"),
                      F.lit(Y0) + F.expr("_k div 120") * 48, F.lit(4.0), F.lit(4.0)).drop("_k", "_l")


def planning_features(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey")
    k = F.col("c_custkey")
    props = F.create_map(F.lit("commune_bfs"), (6600 + k % 25).cast("string"),
                         F.lit("status"), F.when(k % 60 == 0, "inForce").otherwise("planned"),
                         F.lit("valid_from"), F.lit("2025-01-01"))
    df = c.select(F.concat(F.lit("PZ"), k.cast("string")).alias("id"), props.alias("properties"), k.alias("_k"))
    return _box_shape(df, F.lit(X0) + (F.col("_k") * 53) % 5600, F.lit(Y0) + F.col("_k") * 4,
                      F.lit(100.0), F.lit(100.0)).drop("_k")


def building_floor_features(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_quantity", "l_tax", "l_returnflag", "l_linestatus")
    k, ln, q = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity").cast("int")
    props = F.create_map(
        F.lit("OBJECTID"), (k * 10 + ln).cast("string"), F.lit("EGID"), F.col("l_partkey").cast("string"),
        F.lit("COMMUNE"), F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 25).cast("string")),
        F.lit("DESTINATION"), F.col("l_linestatus"), F.lit("NOMEN_CLASSE"), F.col("l_returnflag"),
        F.lit("NIVEAUX_HORSOL"), F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
        .otherwise(F.round(F.col("l_tax") * 100).cast("int").cast("string")),
        F.lit("HAUTEUR"), (q * 3).cast("string"),
        F.lit("ANNEE_CONSTRUCTION"), (1900 + F.col("l_partkey") % 120).cast("string"),
        F.lit("SURFACE"), F.when(ln % 3 == 0, F.lit(None).cast("string")).otherwise((q * 4).cast("string")),
        F.lit("SHAPE.AREA"), (q * 5).cast("string"))
    df = li.select(F.lit(None).cast("string").alias("id"), props.alias("properties"), k.alias("_k"), ln.alias("_l"))
    return _box_shape(df, F.lit(X0) + (F.col("_k") % 120) * 48 + F.col("_l") * 5,
                      F.lit(Y0) + F.expr("_k div 120") * 48, F.lit(4.0), F.lit(4.0)).drop("_k", "_l")


def raisable_features(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    props = F.create_map(
        F.lit("OBJECTID"), k.cast("string"), F.lit("EGID"), (k * 7).cast("string"),
        F.lit("COMMUNE"), F.concat(F.lit("NATION_"), (k % 25).cast("string")),
        F.lit("DESTINATION"), F.col("c_mktsegment"),
        F.lit("REMARQUE"), F.when(k % 2 == 0, F.lit("LCI art. 23")))
    df = c.select(k.cast("string").alias("id"), props.alias("properties"), k.alias("_k"))
    return _box_shape(df, F.lit(X0) + (F.col("_k") * 37) % 5750, F.lit(Y0) + F.col("_k") * 4,
                      F.lit(10.0), F.lit(10.0)).drop("_k")


# ---------------------------------------------------------------------------
# landed JSON documents
# ---------------------------------------------------------------------------

def _coords_json(x1: str, y1: str, x2: str, y2: str, closed: bool = True) -> str:
    pts = [f"[{x1},{y1}]", f"[{x2},{y1}]", f"[{x2},{y2}]", f"[{x1},{y2}]"]
    if closed:
        pts.append(f"[{x1},{y1}]")
    return "[" + ",".join(pts) + "]"


def zoning_geojson_features(spark: SparkSession, d: str) -> DataFrame:
    """Zoning features as GeoJSON Feature strings, with the awkward cases a
    real service returns: MultiPolygon parts, and by number p, first rule first: zero-area rings (19), unclosed rings (17),
    bow-ties (29: one crossing), empty coordinates (31), a repeated vertex (37), a hole without area (41), rings
    with two crossings (43), L-shapes (47), holes (53), GeometryCollections with a point (23); OBJECTID is a JSON
    number for even p. Odd forms take the place of the zone's first rectangle."""
    zf = zoning_features(spark, d)
    x1, y1, x2, y2 = (f"rects[0].{c}" for c in ("xmin", "ymin", "xmax", "ymax"))
    xm, ym = f"(({x1} + {x2}) / 2)", f"(({y1} + {y2}) / 2)"
    qx = [f"({x1} + ({x2} - {x1}) * {q} / 4)" for q in (1, 3)]
    qy = [f"({y1} + ({y2} - {y1}) * {q} / 4)" for q in (1, 3)]
    box = [(x1, y1), (x2, y1), (x2, y2), (x1, y2)]
    poly = lambda *rings: f"concat('{{\"type\":\"Polygon\",\"coordinates\":[', {', \',\', '.join(rings)}, ']}}')"
    second = [(f"rects[1].{a}", f"rects[1].{b}") for a, b in (("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"))]
    whole = f"concat('{{\"type\":\"MultiPolygon\",\"coordinates\":[[', {_sql_ring(box)}, '],[', {_sql_ring(second)}, ']]}}')"
    base = f"CASE WHEN size(rects) = 2 THEN {whole} ELSE {poly(_sql_ring(box))} END"
    coll = (f"concat('{{\"type\":\"GeometryCollection\",\"geometries\":[{{\"type\":\"Point\",\"coordinates\":[',"
            f" {x1}, ',', {y1}, ']}},', {base}, ']}}')")
    hole = [(qx[0], qy[0]), (qx[0], qy[1]), (qx[1], qy[1]), (qx[1], qy[0])]
    forms = {19: poly(_sql_ring([(x1, y1), (x2, y1), (xm, y1)])), 17: poly(_sql_ring(box, False)), 29: poly(_sql_ring([(x1, y1), (x2, y2), (x2, y1), (x1, y2)])),
             31: "'{\"type\":\"Polygon\",\"coordinates\":[]}'", 37: poly(_sql_ring([box[0], *box])), 41: poly(_sql_ring(box), _sql_ring([(x1, y1), (x2, y2)])),
             43: poly(_sql_ring([(x1, y1), (xm, y2), (x2, y1), (x2, y2), (xm, y1), (x1, y2)])), 47: poly(_sql_ring([(x1, y1), (x2, y1), (x2, ym), (xm, ym), (xm, y2), (x1, y2)])),
             53: poly(_sql_ring(box), _sql_ring(hole)), 23: coll}
    k = "cast(id AS bigint)"
    geom = "CASE " + " ".join(f"WHEN {k} % {n} = 0 THEN {f}" for n, f in forms.items()) + f" ELSE {base} END"
    feat = F.concat(F.lit('{"type":"Feature","id":"'), F.col("id"), F.lit('","properties":'),
                    F.when(F.expr(f"{k} % 2 = 0"), F.regexp_replace(F.to_json("properties"), r'"OBJECTID":"([0-9]+)"', r'"OBJECTID":$1'))
                    .otherwise(F.to_json("properties")), F.lit(',"geometry":'), F.expr(geom), F.lit("}"))
    return zf.select("id", feat.alias("feature_json"))


def _sql_ring(points: list[tuple[str, str]], closed: bool = True) -> str:
    """JSON text of a ring, given as SQL expressions of its points."""
    points = points + points[:1] if closed else points
    return "concat('[', " + ", ".join(f"'{',' if i else ''}[', {x}, ',', {y}, ']'" for i, (x, y) in enumerate(points)) + ", ']')"


def zoning_pages(spark: SparkSession, d: str, page_size: int = 100) -> DataFrame:
    """FeatureCollection page documents (page_no, page_json), page_size features
    each; pages are formed from key ranges, so every group is bounded. Every
    third page has also landed a second time, cut off (page_no negative)."""
    f = zoning_geojson_features(spark, d)
    page = F.floor(F.col("id").cast("bigint") / page_size)
    pages = (f.groupBy(page.alias("page_no"))
            .agg(F.concat(F.lit('{"type":"FeatureCollection","features":['),
                          F.array_join(F.collect_list("feature_json"), ","),
                          F.lit("]}")).alias("page_json")))
    cut = pages.where(F.col("page_no") % 3 == 0).select((-1 - F.col("page_no")).alias("page_no"), F.expr("substring(page_json, 1, length(page_json) - 40)").alias("page_json"))
    return pages.unionByName(cut)


def _jstr(c: F.Column) -> F.Column:
    """JSON text of a string value (escaped, quoted; NULL -> null)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def restriction_extracts(spark: SparkSession, d: str) -> DataFrame:
    """One legal-extract JSON document per event (egrid, extract_json).

    Variants: a second restriction (even event_id), a cut-off document (event_id % 50 = 49), Theme.Code missing (event_id % 4 = 0, only Sub_Code given), text
    as a plain string (event_id % 3 = 0), empty French text (event_id % 7 = 0).
    """
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    k, ev = F.col("event_id"), F.col("event_type")
    theme = None
    for name, th in THEME_BY_EVENT.items():
        theme = F.when(ev == name, th) if theme is None else theme.when(ev == name, th)
    fr = F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("Thème "), ev))
    text = F.when(k % 3 == 0, _jstr(F.concat(F.lit("Thème "), ev))).otherwise(
        F.concat(F.lit('[{"Language":"de","Text":'), _jstr(F.concat(F.lit("Thema "), ev)),
                 F.lit('},{"Language":"fr","Text":'), _jstr(fr), F.lit("}]")))
    code = F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit('"Code":'), _jstr(theme), F.lit(",")))
    state = F.when(F.col("value") < 20, "inForce").otherwise("changeWithPreEffect")
    whole = F.concat(
        F.lit('{"GetExtractByIdResponse":{"extract":{"RealEstate":[{"RestrictionOnLandownership":[{"Theme":{'),
        code, F.lit('"Sub_Code":'), _jstr(F.concat(theme, F.lit(".sub"))), F.lit(',"Text":'), text,
        F.lit('},"SubTheme":null,"Lawstatus":{"Code":'), _jstr(state), F.lit("}}"),
        F.when(k % 2 == 0, F.lit(',{"Theme":{"Code":"LandUsePlans","Text":"Plan"},"SubTheme":"zone","Lawstatus":{"Code":"inForce"}}')).otherwise(""),
        F.lit("]}]}}}"))
    doc = F.when(k % 50 == 49, F.substring("doc", 1, 60)).otherwise(F.col("doc"))
    return (e.withColumn("doc", whole)
            .select(F.concat(F.lit("CH"), F.lpad(k.cast("string"), 12, "0")).alias("egrid"),
                    doc.alias("extract_json")))


def wgs84_zone_features(spark: SparkSession, d: str) -> DataFrame:
    """GeoJSON features of which every third (p % 3 = 0) is given in WGS84
    degrees instead of LV95 metres (id, geometry)."""
    p = table(spark, d, "part").select("p_partkey")
    k = F.col("p_partkey")
    lon1 = F.lit(6.1) + (k % 20) * 0.004
    lat1 = F.lit(46.2) + F.expr("p_partkey div 20") * 0.0006
    x1 = F.lit(X0) + (k % 20) * 288
    y1 = F.lit(Y0) + F.expr("p_partkey div 20") * 60
    deg = (lon1, lat1, lon1 + 0.003, lat1 + 0.0005)
    lv = (x1, y1, x1 + 288, y1 + 60)

    def ring(a, b, c, e):
        pts = [(a, b), (c, b), (c, e), (a, e), (a, b)]
        return F.concat(F.lit('{"type":"Polygon","coordinates":[['),
                        *sum(([F.lit("," if i else ""), F.lit("["), x.cast("string"), F.lit(","),
                               y.cast("string"), F.lit("]")] for i, (x, y) in enumerate(pts)), []),
                        F.lit("]]}"))
    return p.select(k.cast("string").alias("id"),
                    F.when(k % 3 == 0, ring(*deg)).otherwise(ring(*lv)).alias("geometry"))
