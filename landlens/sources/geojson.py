"""Landed GeoJSON pages and legal extracts -> typed DataFrames.

* ``write_lines`` / ``read_pages(spark, path)``: landed FeatureCollection documents, one per line, in compressed files of bounded length.
* ``explode_pages(df)`` / ``page_status(df)``: features of the good pages / every page with its feature count or "corrupt".
* ``geometry(col)``: GeoJSON geometry text -> multipolygon array (Polygon,
  MultiPolygon, polygonal members of a GeometryCollection; other types drop).
* ``screen(features)``: geometry repair (close rings, drop repeated vertices, degenerate rings and holes, rebuild crossing
  rings) -> ``status`` / ``reason``; what cannot be repaired stays as a rejected row.
* ``flatten_extracts(df)`` / ``extract_status(df)``: legal extract JSON -> one row per restriction / per document.

Everything is JSON parsing by Spark's own readers (``from_json`` /
``try_parse_json`` + ``variant_get``); only rings that may cross go through an Arrow kernel. Properties are texts; one that the JSON
held as a number starts with ``rules.NUMBER_MARK``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import rules as R
from ..operators.repair import uncross

FEATURE_T = "struct<id:string,properties:string,geometry:string>"
CORRUPT = "_corrupt_page"
PAGE_T = f"struct<type:string,features:array<{FEATURE_T}>,{CORRUPT}:string>"
_POLY_T = "struct<coordinates:array<array<array<double>>>>"
_MULTI_T = "struct<coordinates:array<array<array<array<double>>>>>"
_COLL_T = "struct<geometries:array<string>>"


def _properties(col: str) -> Column:
    """JSON object text -> map<string, string>; numbers keep a mark, so that 5, 5.0 and "5" can be told apart."""
    return F.expr(f"""transform_values(from_json({col}, 'map<string,variant>'), (vk_, vv_) ->
        CASE WHEN schema_of_variant(vv_) RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)' THEN concat('{R.NUMBER_MARK}', cast(vv_ AS string))
             ELSE cast(vv_ AS string) END)""")


def _parsed_pages(df: DataFrame, col: str, page_col: str) -> DataFrame:
    page = F.from_json(col, PAGE_T, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.select(F.col(page_col).alias("page_no"), page.alias("_p"))


def explode_pages(df: DataFrame, col: str = "page_json", page_col: str = "page_no") -> DataFrame:
    """(page_no, page_json) -> (id, properties, geometry, page_no), one row per feature of every readable page."""
    good = _parsed_pages(df, col, page_col).where(F.col(f"_p.{CORRUPT}").isNull())
    return (good.select("page_no", F.explode("_p.features").alias("f"))
            .select("f.id", _properties("f.properties").alias("properties"), "f.geometry", "page_no"))


def page_status(df: DataFrame, col: str = "page_json", page_col: str = "page_no") -> DataFrame:
    """Every landed page: (page_no, status, n_features); a truncated or malformed one is 'corrupt' with 0 features."""
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull() | F.col("_p.features").isNull()
    return _parsed_pages(df, col, page_col).select(
        "page_no", F.when(bad, "corrupt").otherwise("ok").alias("status"),
        F.when(bad, F.lit(0)).otherwise(F.size("_p.features")).cast("bigint").alias("n_features"))


def page_account(df: DataFrame, col: str = "page_json", page_col: str = "page_no") -> DataFrame:
    """status: one row per page ("page ok", "page corrupt") and one per feature of every readable page ("feature ok", ...), from one reading of the pages."""
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull() | F.col("_p.features").isNull()
    row = lambda page, geometry: F.struct(page.cast("string").alias("page"), geometry.cast("string").alias("geometry"))
    own = F.array(row(F.when(bad, "page corrupt").otherwise("page ok"), F.lit(None)))
    found = F.when(bad, F.array().cast(own_type := "array<struct<page:string,geometry:string>>")).otherwise(
        F.transform("_p.features", lambda f: row(F.lit(None), f["geometry"])).cast(own_type))
    rows = _parsed_pages(df, col, page_col).select(F.explode(F.concat(own.cast(own_type), found)).alias("r")).select("r.*")
    return to_features(rows).select(F.coalesce("page", F.concat(F.lit("feature "), "status")).alias("status"))


#: Landed documents in one file: a compressed file does not split, so a large folder is many files.
PAGES_IN_FILE, EXTRACTS_IN_FILE = 1000, 50000


def write_lines(lines: DataFrame, path: str, in_file: int) -> None:
    """Land documents, one a line, in compressed files of at most ``in_file`` lines. JSON repeats its names: as plain text it takes some ten times the room."""
    lines.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", in_file).text(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Land (page_no, page_json) rows as lines of JSON documents."""
    write_lines(pages.select(F.to_json(F.struct(F.col("page_no"), F.col("page_json"))).alias("value")), path, PAGES_IN_FILE)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_no, page_json) of landed pages, one per line, compressed or not."""
    line = F.from_json("value", "struct<page_no:bigint,page_json:string>")
    return spark.read.text(path).select(line.alias("l")).select("l.page_no", "l.page_json")


def _pts(arr: str) -> str:
    return f"transform({arr}, vq_ -> named_struct('x', get(vq_, 0), 'y', get(vq_, 1)))"


def _poly_sql(g: str) -> str:
    return f"transform(from_json({g}, '{_POLY_T}').coordinates, vrr_ -> {_pts('vrr_')})"


def _multi_sql(g: str) -> str:
    return (f"transform(from_json({g}, '{_MULTI_T}').coordinates,"
            f" vpp_ -> transform(vpp_, vrr_ -> {_pts('vrr_')}))")


def _type_sql(g: str) -> str:
    return f"get_json_object({g}, '$.type')"


def _polygonal_sql(g: str, t: str) -> str:
    return (f"CASE WHEN {t} = 'Polygon' THEN array({_poly_sql(g)})"
            f" WHEN {t} = 'MultiPolygon' THEN {_multi_sql(g)} END")


def geometry(col: str = "geometry") -> Column:
    """GeoJSON text -> multipolygon (ST_CollectionExtract(..., 3) + ST_Multi)."""
    coll = (f"flatten(transform(filter(from_json({col}, '{_COLL_T}').geometries,"
            f" vm_ -> get_json_object(vm_, '$.type') IN ('Polygon', 'MultiPolygon')),"
            f" vm_ -> {_let('vmt_', _type_sql('vm_'), _polygonal_sql('vm_', 'vmt_'))}))")
    return F.expr(_let("vt_", _type_sql(col), f"CASE WHEN vt_ = 'GeometryCollection' THEN {coll} ELSE {_polygonal_sql(col, 'vt_')} END"))


def geometry_type(col: str = "geometry") -> Column:
    return F.get_json_object(F.col(col), "$.type")


def _clean_ring(r: str) -> str:
    """Ring without missing or repeated vertices, closed."""
    known = f"filter({r}, vn_ -> vn_.x IS NOT NULL AND vn_.y IS NOT NULL)"
    once = f"transform(array({known}), vkn_ -> filter(vkn_, (vd_, vdi_) -> vdi_ = 0 OR vd_ <> vkn_[vdi_ - 1]))[0]"
    return (f"transform(array({once}), vcl_ -> CASE WHEN size(vcl_) > 0 AND vcl_[0] <> vcl_[size(vcl_) - 1]"
            f" THEN concat(vcl_, array(vcl_[0])) ELSE vcl_ END)[0]")


def _ring_area(r: str) -> str:
    return (f"(aggregate(sequence(0, size({r}) - 2), 0D, (va_, vj_) -> va_ + ({r}[vj_].x - {r}[0].x) * ({r}[vj_ + 1].y - {r}[0].y)"
            f" - ({r}[vj_ + 1].x - {r}[0].x) * ({r}[vj_].y - {r}[0].y)))")


def _flat(r: str) -> str:
    """Too few points, or all on one line."""
    return (f"(size({r}) < 4 OR forall(sequence(1, size({r}) - 2), vl_ -> ({r}[vl_].x - {r}[0].x) * ({r}[vl_ + 1].y - {r}[0].y)"
            f" = ({r}[vl_ + 1].x - {r}[0].x) * ({r}[vl_].y - {r}[0].y)))")


def screen(features: DataFrame, geom: str = "geom") -> DataFrame:
    """Geometry repair (re-aimed ST_MakeValid), part by part.

    Rings lose missing and repeated vertices and are closed. A part whose outer ring has fewer than 4 points or no area is dropped,
    a hole likewise without its part. Rings that cross themselves or each other are rebuilt from simple loops (operators.repair); rings that only touch
    are fine. A geometry with nothing left is a rejected row with its reason."""
    rings = f"transform(filter(coalesce(vgeom_, array()), vp_ -> size(vp_) > 0), vp_ -> transform(vp_, vr_ -> {_clean_ring('vr_')}))"
    parts = (f"transform(filter(vg_all_, vp_ -> NOT {_flat('vp_[0]')}), vp_ -> concat(slice(vp_, 1, 1),"
             f" filter(slice(vp_, 2, greatest(size(vp_) - 1, 0)), vr_ -> NOT {_flat('vr_')})))")
    reason = ("CASE WHEN size(vg_all_) = 0 THEN 'no polygon' WHEN size(vparts_) = 0 AND forall(vg_all_, vp_ -> size(vp_[0]) < 4) THEN 'ring with < 4 points'"
              " WHEN size(vparts_) = 0 THEN 'zero-area ring' END")
    # triangles and rectangles alone cannot cross themselves
    plain = f"forall(vparts_, vp_ -> size(vp_) = 1 AND (size(vp_[0]) < 5 OR {G._is_rect_ring('vp_[0]')}))"
    repaired = _let("vg_all_", rings, _let("vparts_", parts, f"named_struct('reason', {reason}, 'parts', vparts_, 'plain', {plain}, 'sound', false)"))
    # nothing to repair where every part is one closed rectangle with an area: most features, so the steps below are left out for them
    box = lambda p: f"size({p}) = 1 AND {G._is_rect_ring(f'{p}[0]')} AND ({p}[0][2].x - {p}[0][0].x) * ({p}[0][2].y - {p}[0][0].y) <> 0"
    sound = f"coalesce(CASE WHEN size({geom}) = 1 THEN {box(f'{geom}[0]')} ELSE size({geom}) > 0 AND forall({geom}, vp_ -> {box('vp_')}) END, false)"
    bound = f"CASE WHEN {sound} THEN named_struct('reason', cast(NULL AS string), 'parts', {geom}, 'plain', true, 'sound', true) ELSE {_let('vgeom_', geom, repaired)} END"
    found = features.withColumn("_s", F.expr(bound)).withColumn("_u", uncross(F.when(~F.col("_s.plain"), F.col("_s.parts"))))
    done = F.expr(f"CASE WHEN _s.sound THEN _s.parts ELSE filter(coalesce(_u, _s.parts), vq_ -> {_ring_area('vq_[0]')} <> 0) END")
    kept = F.col("reason").isNull()
    return (found.withColumn("_done", done)
            .withColumn("reason", F.coalesce("_s.reason", F.when(F.size("_done") == 0, F.lit("zero-area ring"))))
            .withColumn("status", F.when(~kept, "rejected").when(F.col("_s.sound") | F.col("_done").eqNullSafe(F.col(geom)), "ok").otherwise("repaired"))
            .withColumn(geom, F.when(kept, F.col("_done"))).drop("_s", "_u", "_done"))


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def to_features(raw: DataFrame) -> DataFrame:
    """Parsed features -> (id, properties, page_no?, geom, shape, status, reason);
    LV95 output, WGS84 input transformed (detected per geometry)."""
    f = raw.withColumn("geom", geometry("geometry"))
    f = screen(f).withColumn("geom", G.to_lv95("geom"))
    return f.withColumn("shape", F.when(F.col("geom").isNotNull(), G.shape("geom")))


def flatten_extracts(extracts: DataFrame, lang: str = "fr") -> DataFrame:
    """(egrid, extract_json) -> (egrid, theme_code, theme_text, sub_theme, legal_state)."""
    v = F.try_parse_json(F.col("extract_json"))  # malformed documents give no rows; see extract_status
    res = F.expr("try_variant_get(_v, '$.GetExtractByIdResponse.extract.RealEstate', 'array<variant>')")
    rows = (extracts.select("egrid", v.alias("_v"))
            .select("egrid", F.explode(res).alias("_re"))
            .select("egrid", F.explode(F.expr(
                "try_variant_get(_re, '$.RestrictionOnLandownership', 'array<variant>')")).alias("_r")))
    code = F.expr("try_variant_get(_r, '$.Theme.Code', 'string')")
    sub = F.expr("try_variant_get(_r, '$.Theme.Sub_Code', 'string')")
    text_list = F.expr("try_variant_get(_r, '$.Theme.Text', 'array<struct<Language:string,Text:string>>')")
    text_str = F.expr("try_variant_get(_r, '$.Theme.Text', 'string')")
    out = rows.select(
        "egrid",
        F.coalesce(R.nonempty(code), sub).alias("theme_code"),
        text_list.alias("_tl"), text_str.alias("_ts"),
        F.expr("try_variant_get(_r, '$.SubTheme', 'string')").alias("sub_theme"),
        F.expr("try_variant_get(_r, '$.Lawstatus.Code', 'string')").alias("legal_state"))
    text = F.when(F.col("_tl").isNotNull(), R.localized_text("_tl", lang)).otherwise(R.nonempty(F.col("_ts")))
    return out.select("egrid", "theme_code", text.alias("theme_text"), "sub_theme", "legal_state")


def extract_status(extracts: DataFrame) -> DataFrame:
    """Every landed extract: (egrid, status, n_restrictions); status 'ok', 'malformed' (no JSON) or 'empty' (no restriction list)."""
    v = F.try_parse_json(F.col("extract_json"))
    lists = F.expr("transform(try_variant_get(_v, '$.GetExtractByIdResponse.extract.RealEstate', 'array<variant>'),"
                   " ve_ -> coalesce(size(try_variant_get(ve_, '$.RestrictionOnLandownership', 'array<variant>')), 0))")
    n = F.coalesce(F.aggregate("_n", F.lit(0), lambda acc, x: acc + x), F.lit(0)).cast("bigint")
    return (extracts.select("egrid", v.alias("_v")).withColumn("_n", lists)
            .select("egrid", F.when(F.col("_v").isNull(), "malformed").when(n == 0, "empty").otherwise("ok").alias("status"), n.alias("n_restrictions")))
