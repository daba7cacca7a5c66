"""Planar geometry as Spark SQL expressions (no UDF, no native geometry type).

Representation
--------------
``geom``  ARRAY<ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>>  multipolygon:
          parts -> rings (first = outer, rest = holes) -> closed point lists.

``shape`` STRUCT derived once per row, the only thing spatial joins carry:
          xmin/ymin/xmax/ymax  bounding box
          area                 |outer| - sum |holes|, summed over parts
          nparts               number of polygon parts
          rect                 single part, single axis-aligned rectangle ring;
                               then the bbox IS the geometry and no array is
                               stored (rows stay small through shuffles)
          rects                ARRAY<rect> when every part is a plain rectangle
                               (exact closed-form fast path), else NULL
          segs                 oriented segments (outer CCW, holes CW) for the
                               general path; NULL when rectangles suffice
          probes               first vertex of each part (point-in-polygon
                               seed) for the general path

Pair functions pick the cheapest exact path per row with CASE WHEN, which Spark
evaluates lazily: rectangle pairs never touch the higher-order-function path.
All coordinates are metric (LV95), so areas are m^2 directly.

Overlap area of general polygons uses the edge-pair identity: for consistently
oriented boundaries and a common local origin,
  area(A n B) = sum_i sum_j sgn(dx_i) sgn(dx_j) * integral over the shared
                x-range of min(y_i(x), y_j(x)) dx
(vertical edges contribute nothing). It is exact for concave, holed and
multi-part polygons and needs only arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT_T = "struct<x:double,y:double>"
GEOM_T = f"array<array<array<{POINT_T}>>>"
RECT_T = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
SEG_T = "struct<x1:double,y1:double,x2:double,y2:double>"
SHAPE_T = (f"struct<xmin:double,ymin:double,xmax:double,ymax:double,area:double,nparts:int,"
           f"rect:boolean,rects:array<{RECT_T}>,segs:array<{SEG_T}>,"
           f"probes:array<{POINT_T}>>")


# Column metadata flag: every row of the shape column is made of axis-aligned
# rectangles. Spatial joins between two such columns emit only the compact
# closed-form expressions (small plans, fully code-generated); anything else
# gets the general exact path.
RECT_ONLY = "landlens.rect_only"


def mark_rect_only(df, col: str = "shape"):
    return df.withMetadata(col, {RECT_ONLY: True})


def is_rect_only(df, col: str = "shape") -> bool:
    return bool(df.schema[col].metadata.get(RECT_ONLY, False))


# ---------------------------------------------------------------------------
# constructors
# ---------------------------------------------------------------------------

def envelope(xmin, ymin, xmax, ymax) -> Column:
    """Axis-aligned rectangle as a one-part multipolygon (outer ring CCW)."""
    x1, y1, x2, y2 = (F.col(c).cast("double") if isinstance(c, str) else c.cast("double")
                      for c in (xmin, ymin, xmax, ymax))

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(pt(x1, y1), pt(x2, y1), pt(x2, y2), pt(x1, y2), pt(x1, y1))
    return F.array(F.array(ring))


def rects_to_geom(rects: str) -> Column:
    """ARRAY<rect> -> multipolygon, one rectangle part per element."""
    return F.expr(
        f"transform({rects}, vq_ -> array(array("
        f"named_struct('x', vq_.xmin, 'y', vq_.ymin), named_struct('x', vq_.xmax, 'y', vq_.ymin),"
        f"named_struct('x', vq_.xmax, 'y', vq_.ymax), named_struct('x', vq_.xmin, 'y', vq_.ymax),"
        f"named_struct('x', vq_.xmin, 'y', vq_.ymin))))")


def multi(polygon: str) -> Column:
    """Force a single polygon (ARRAY<ring>) into a one-part multipolygon."""
    return F.expr(f"array({polygon})")


def shape_from_rects(rects: str) -> Column:
    """Shape of a geometry made only of axis-aligned rectangles (cheap path)."""
    return F.expr(f"""named_struct(
        'xmin', array_min(transform({rects}, vq_ -> vq_.xmin)),
        'ymin', array_min(transform({rects}, vq_ -> vq_.ymin)),
        'xmax', array_max(transform({rects}, vq_ -> vq_.xmax)),
        'ymax', array_max(transform({rects}, vq_ -> vq_.ymax)),
        'area', aggregate({rects}, 0D, (va_, vq_) -> va_ + (vq_.xmax - vq_.xmin) * (vq_.ymax - vq_.ymin)),
        'nparts', size({rects}),
        'rect', size({rects}) = 1,
        'rects', CASE WHEN size({rects}) <> 1 THEN {rects} END,
        'segs', cast(NULL AS array<{SEG_T}>),
        'probes', cast(NULL AS array<{POINT_T}>))""")


def shape_from_box(xmin: str, ymin: str, xmax: str, ymax: str) -> Column:
    """Shape of one rectangle given by four numeric columns (scalars only)."""
    return F.expr(f"""named_struct(
        'xmin', cast({xmin} AS double), 'ymin', cast({ymin} AS double),
        'xmax', cast({xmax} AS double), 'ymax', cast({ymax} AS double),
        'area', (cast({xmax} AS double) - {xmin}) * (cast({ymax} AS double) - {ymin}),
        'nparts', 1,
        'rect', true,
        'rects', cast(NULL AS array<{RECT_T}>),
        'segs', cast(NULL AS array<{SEG_T}>),
        'probes', cast(NULL AS array<{POINT_T}>))""")


# ---------------------------------------------------------------------------
# single-geometry measures (SQL text builders)
# ---------------------------------------------------------------------------

def _ring_signed_area(r: str) -> str:
    # shoelace relative to the ring's first vertex (keeps products small/exact)
    return (f"(aggregate(sequence(0, size({r}) - 2), 0D, (acc_s, j_s) -> acc_s"
            f" + ({r}[j_s].x - {r}[0].x) * ({r}[j_s + 1].y - {r}[0].y)"
            f" - ({r}[j_s + 1].x - {r}[0].x) * ({r}[j_s].y - {r}[0].y)) / 2)")


def _is_rect_ring(r: str) -> str:
    return (f"(size({r}) = 5 AND {r}[0] = {r}[4] AND {r}[0].x <> {r}[2].x AND {r}[0].y <> {r}[2].y"
            f" AND (({r}[0].y = {r}[1].y AND {r}[1].x = {r}[2].x AND {r}[2].y = {r}[3].y AND {r}[3].x = {r}[4].x)"
            f"   OR ({r}[0].x = {r}[1].x AND {r}[1].y = {r}[2].y AND {r}[2].x = {r}[3].x AND {r}[3].y = {r}[4].y)))")


def _rect_of_ring(r: str) -> str:
    return (f"named_struct('xmin', least({r}[0].x, {r}[2].x), 'ymin', least({r}[0].y, {r}[2].y),"
            f" 'xmax', greatest({r}[0].x, {r}[2].x), 'ymax', greatest({r}[0].y, {r}[2].y))")


def area_sql(g: str) -> str:
    """ST_Area: per part |outer| - sum |holes|."""
    outer = _ring_signed_area("vpa_[0]")
    holes = _ring_signed_area("vrh_")
    return (f"aggregate({g}, 0D, (acc_a, vpa_) -> acc_a + abs({outer})"
            f" - aggregate(slice(vpa_, 2, greatest(size(vpa_) - 1, 0)), 0D, (acc_h, vrh_) -> acc_h + abs({holes})))")


def area(g: str) -> Column:
    return F.expr(area_sql(g))


def bbox(g: str) -> Column:
    pts = f"flatten(flatten({g}))"
    return F.expr(f"""named_struct(
        'xmin', array_min(transform({pts}, vp_ -> vp_.x)), 'ymin', array_min(transform({pts}, vp_ -> vp_.y)),
        'xmax', array_max(transform({pts}, vp_ -> vp_.x)), 'ymax', array_max(transform({pts}, vp_ -> vp_.y)))""")


def num_parts(g: str) -> Column:
    return F.expr(f"size({g})")


def _oriented_segs_sql(g: str) -> str:
    # outer rings CCW (positive), holes CW: flip a ring whose sign is wrong
    sa = _ring_signed_area("vro_")
    seg_fwd = "named_struct('x1', vro_[vk_].x, 'y1', vro_[vk_].y, 'x2', vro_[vk_ + 1].x, 'y2', vro_[vk_ + 1].y)"
    seg_rev = "named_struct('x1', vro_[vk_ + 1].x, 'y1', vro_[vk_ + 1].y, 'x2', vro_[vk_].x, 'y2', vro_[vk_].y)"
    return (f"flatten(flatten(transform({g}, vpo_ -> transform(vpo_, (vro_, vio_) -> transform("
            f"sequence(0, size(vro_) - 2), vk_ -> CASE WHEN (vio_ = 0) = ({sa} >= 0) THEN {seg_fwd} ELSE {seg_rev} END)))))")


def shape(g: str, general: bool = False) -> Column:
    """Full shape struct from a multipolygon column (general input path).

    ``general=True`` keeps segments/probes even for rectangles, forcing the
    general exact path (used to check it against rectangle arithmetic).
    """
    pts = f"flatten(flatten({g}))"
    all_rect = "false" if general else f"forall({g}, vpr_ -> size(vpr_) = 1 AND {_is_rect_ring('vpr_[0]')})"
    return F.expr(f"""named_struct(
        'xmin', array_min(transform({pts}, vp_ -> vp_.x)),
        'ymin', array_min(transform({pts}, vp_ -> vp_.y)),
        'xmax', array_max(transform({pts}, vp_ -> vp_.x)),
        'ymax', array_max(transform({pts}, vp_ -> vp_.y)),
        'area', {area_sql(g)},
        'nparts', size({g}),
        'rect', size({g}) = 1 AND {all_rect},
        'rects', CASE WHEN size({g}) <> 1 AND {all_rect} THEN transform({g}, vpr_ -> {_rect_of_ring('vpr_[0]')}) END,
        'segs', CASE WHEN NOT {all_rect} THEN {_oriented_segs_sql(g)} END,
        'probes', CASE WHEN NOT {all_rect} THEN transform({g}, vpr_ -> vpr_[0][0]) END)""")


def _rects_of(s: str) -> str:
    """Rectangles of a rectangle-only shape (the bbox for a single one)."""
    return (f"CASE WHEN {s}.rect THEN array(named_struct('xmin', {s}.xmin, 'ymin', {s}.ymin,"
            f" 'xmax', {s}.xmax, 'ymax', {s}.ymax)) ELSE {s}.rects END")


def slim(s: str) -> Column:
    """What predicates and measures of rectangle shapes read: all that a join between such layers has to carry."""
    return F.expr("named_struct(" + ", ".join(f"'{c}', {s}.{c}" for c in ("xmin", "ymin", "xmax", "ymax", "area", "rect", "rects")) + ")")


def _probes_of(s: str) -> str:
    return f"coalesce({s}.probes, transform({_rects_of(s)}, vq_ -> named_struct('x', vq_.xmin, 'y', vq_.ymin)))"


def _all_rect(s: str) -> str:
    return f"({s}.rect OR {s}.rects IS NOT NULL)"


def _segs_of(s: str) -> str:
    """Segments of a shape; rectangle shapes get theirs on the fly (CCW)."""
    return (f"coalesce({s}.segs, flatten(transform({_rects_of(s)}, vq_ -> array("
            f"named_struct('x1', vq_.xmin, 'y1', vq_.ymin, 'x2', vq_.xmax, 'y2', vq_.ymin),"
            f"named_struct('x1', vq_.xmax, 'y1', vq_.ymin, 'x2', vq_.xmax, 'y2', vq_.ymax),"
            f"named_struct('x1', vq_.xmax, 'y1', vq_.ymax, 'x2', vq_.xmin, 'y2', vq_.ymax),"
            f"named_struct('x1', vq_.xmin, 'y1', vq_.ymax, 'x2', vq_.xmin, 'y2', vq_.ymin)))))")


# ---------------------------------------------------------------------------
# pair predicates / measures on two shape structs (SQL text)
# ---------------------------------------------------------------------------

def bbox_intersects_sql(a: str, b: str, d: float = 0.0) -> str:
    return (f"({a}.xmin - {d} <= {b}.xmax AND {b}.xmin <= {a}.xmax + {d}"
            f" AND {a}.ymin - {d} <= {b}.ymax AND {b}.ymin <= {a}.ymax + {d})")


def _rect_overlap(p: str, q: str) -> str:
    return (f"greatest(least({p}.xmax, {q}.xmax) - greatest({p}.xmin, {q}.xmin), 0D)"
            f" * greatest(least({p}.ymax, {q}.ymax) - greatest({p}.ymin, {q}.ymin), 0D)")


def _norm_edges(s: str, ox: str, oy: str) -> str:
    """Non-vertical edges of a shape, each once as left/right x and y relative
    to the pair's origin plus the sign of its direction (O(E), per side)."""
    return (f"transform(filter({_segs_of(s)}, vs_ -> vs_.x1 <> vs_.x2), vs_ -> named_struct("
            f"'xl', least(vs_.x1, vs_.x2) - {ox}, 'xr', greatest(vs_.x1, vs_.x2) - {ox},"
            f" 'yl', CASE WHEN vs_.x1 < vs_.x2 THEN vs_.y1 ELSE vs_.y2 END - {oy},"
            f" 'yr', CASE WHEN vs_.x1 < vs_.x2 THEN vs_.y2 ELSE vs_.y1 END - {oy},"
            f" 'sg', signum(vs_.x2 - vs_.x1)))")


def _edge_pair_area(a: str, b: str) -> str:
    ox, oy = f"least({a}.xmin, {b}.xmin)", f"least({a}.ymin, {b}.ymin)"
    lo = "greatest(ve_.xl, vf_.xl)"
    hi = "least(ve_.xr, vf_.xr)"

    def yat(v, x):
        return f"({v}.yl + ({x} - {v}.xl) * ({v}.yr - {v}.yl) / ({v}.xr - {v}.xl))"

    yel, yer, yfl, yfr = yat("ve_", lo), yat("ve_", hi), yat("vf_", lo), yat("vf_", hi)
    dl, dr = f"({yel} - {yfl})", f"({yer} - {yfr})"
    t = f"({dl} / ({dl} - {dr}))"
    xc = f"({t} * ({hi} - {lo}))"
    yc = f"({yel} + {t} * ({yer} - {yel}))"
    same = f"({hi} - {lo}) * (least({yel}, {yfl}) + least({yer}, {yfr})) / 2"
    split = (f"{xc} * (least({yel}, {yfl}) + {yc}) / 2"
             f" + ({hi} - {lo} - {xc}) * ({yc} + least({yer}, {yfr})) / 2")
    term = (f"CASE WHEN {hi} <= {lo} THEN 0D ELSE ve_.sg * vf_.sg"
            f" * CASE WHEN {dl} * {dr} >= 0 THEN {same} ELSE {split} END END")
    # bind both normalised edge lists once (a one-element transform acts as a let)
    return (f"greatest(element_at(transform(array(named_struct('na', {_norm_edges(a, ox, oy)},"
            f" 'nb', {_norm_edges(b, ox, oy)})), vz_ -> aggregate(vz_.na, 0D, (acc_e, ve_) -> acc_e"
            f" + aggregate(vz_.nb, 0D, (acc_f, vf_) -> acc_f + {term}))), 1), 0D)")


def overlap_area_sql(a: str, b: str, rect_only: bool = False) -> str:
    """ST_Area(ST_Intersection(a, b)) for two shape structs."""
    rects = (f"aggregate({_rects_of(a)}, 0D, (acc_p, vp_) -> acc_p + aggregate({_rects_of(b)}, 0D,"
             f" (acc_q, vq_) -> acc_q + {_rect_overlap('vp_', 'vq_')}))")
    if rect_only:
        return f"CASE WHEN {a}.rect AND {b}.rect THEN {_rect_overlap(a, b)} ELSE {rects} END"
    return (f"CASE WHEN NOT {bbox_intersects_sql(a, b)} THEN 0D"
            f" WHEN {a}.rect AND {b}.rect THEN {_rect_overlap(a, b)}"
            f" WHEN {_all_rect(a)} AND {_all_rect(b)} THEN {rects}"
            f" ELSE {_edge_pair_area(a, b)} END")


def _orient(ax, ay, bx, by, cx, cy) -> str:
    return f"signum(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


def _seg_intersects(e: str, f: str) -> str:
    o1 = _orient(f"{e}.x1", f"{e}.y1", f"{e}.x2", f"{e}.y2", f"{f}.x1", f"{f}.y1")
    o2 = _orient(f"{e}.x1", f"{e}.y1", f"{e}.x2", f"{e}.y2", f"{f}.x2", f"{f}.y2")
    o3 = _orient(f"{f}.x1", f"{f}.y1", f"{f}.x2", f"{f}.y2", f"{e}.x1", f"{e}.y1")
    o4 = _orient(f"{f}.x1", f"{f}.y1", f"{f}.x2", f"{f}.y2", f"{e}.x2", f"{e}.y2")
    box = (f"(least({e}.x1, {e}.x2) <= greatest({f}.x1, {f}.x2) AND least({f}.x1, {f}.x2) <= greatest({e}.x1, {e}.x2)"
           f" AND least({e}.y1, {e}.y2) <= greatest({f}.y1, {f}.y2) AND least({f}.y1, {f}.y2) <= greatest({e}.y1, {e}.y2))")
    return f"({o1} * {o2} <= 0 AND {o3} * {o4} <= 0 AND {box})"


def _point_in(p: str, segs: str) -> str:
    """Crossing-number parity of point p against all rings (given as segments)."""
    cross = (f"((vg_.y1 > {p}.y) <> (vg_.y2 > {p}.y)) AND "
             f"({p}.x < vg_.x1 + ({p}.y - vg_.y1) * (vg_.x2 - vg_.x1) / (vg_.y2 - vg_.y1))")
    return f"(size(filter({segs}, vg_ -> {cross})) % 2 = 1)"


def _let_segs(a: str, b: str, body: str) -> str:
    """Evaluate ``body`` with both segment lists bound once as vz_.sa / vz_.sb."""
    return (f"element_at(transform(array(named_struct('sa', {_segs_of(a)}, 'sb', {_segs_of(b)})),"
            f" vz_ -> {body}), 1)")


def _general_intersects_body(a: str, b: str) -> str:
    return (f"(exists(vz_.sa, ve_ -> exists(vz_.sb, vf_ -> {_seg_intersects('ve_', 'vf_')}))"
            f" OR exists({_probes_of(a)}, vpa_ -> {_point_in('vpa_', 'vz_.sb')})"
            f" OR exists({_probes_of(b)}, vpb_ -> {_point_in('vpb_', 'vz_.sa')}))")


def _general_intersects(a: str, b: str) -> str:
    return _let_segs(a, b, _general_intersects_body(a, b))


def intersects_sql(a: str, b: str, rect_only: bool = False) -> str:
    """ST_Intersects (closed: touching counts)."""
    rects = f"exists({_rects_of(a)}, vp_ -> exists({_rects_of(b)}, vq_ -> {bbox_intersects_sql('vp_', 'vq_')}))"
    if rect_only:
        return f"({bbox_intersects_sql(a, b)} AND (({a}.rect AND {b}.rect) OR {rects}))"
    return (f"CASE WHEN NOT {bbox_intersects_sql(a, b)} THEN false"
            f" WHEN {a}.rect AND {b}.rect THEN true"
            f" WHEN {_all_rect(a)} AND {_all_rect(b)} THEN {rects}"
            f" ELSE {_general_intersects(a, b)} END")


def _pt_seg_d2(px: str, py: str, s: str) -> str:
    dx, dy = f"({s}.x2 - {s}.x1)", f"({s}.y2 - {s}.y1)"
    len2 = f"({dx} * {dx} + {dy} * {dy})"
    t = (f"CASE WHEN {len2} = 0 THEN 0D ELSE least(greatest((({px} - {s}.x1) * {dx}"
         f" + ({py} - {s}.y1) * {dy}) / {len2}, 0D), 1D) END")
    qx, qy = f"({s}.x1 + ({t}) * {dx})", f"({s}.y1 + ({t}) * {dy})"
    return f"(({px} - {qx}) * ({px} - {qx}) + ({py} - {qy}) * ({py} - {qy}))"


def _rect_gap2(p: str, q: str) -> str:
    gx = f"greatest({p}.xmin - {q}.xmax, {q}.xmin - {p}.xmax, 0D)"
    gy = f"greatest({p}.ymin - {q}.ymax, {q}.ymin - {p}.ymax, 0D)"
    return f"({gx} * {gx} + {gy} * {gy})"


def dwithin_sql(a: str, b: str, d: float, rect_only: bool = False) -> str:
    """ST_DWithin(a, b, d): planar distance <= d (0 when intersecting)."""
    d2 = float(d) * float(d)
    if rect_only:
        return (f"CASE WHEN {a}.rect AND {b}.rect THEN {_rect_gap2(a, b)} <= {d2}"
                f" ELSE exists({_rects_of(a)}, vp_ -> exists({_rects_of(b)}, vq_ -> {_rect_gap2('vp_', 'vq_')} <= {d2})) END")
    seg_d2 = (f"least({_pt_seg_d2('ve_.x1', 've_.y1', 'vf_')}, {_pt_seg_d2('ve_.x2', 've_.y2', 'vf_')},"
              f" {_pt_seg_d2('vf_.x1', 'vf_.y1', 've_')}, {_pt_seg_d2('vf_.x2', 'vf_.y2', 've_')})")
    return (f"CASE WHEN NOT {bbox_intersects_sql(a, b, d)} THEN false"
            f" WHEN {a}.rect AND {b}.rect THEN {_rect_gap2(a, b)} <= {d2}"
            f" WHEN {_all_rect(a)} AND {_all_rect(b)} THEN"
            f" exists({_rects_of(a)}, vp_ -> exists({_rects_of(b)}, vq_ -> {_rect_gap2('vp_', 'vq_')} <= {d2}))"
            f" ELSE {_let_segs(a, b, f'({_general_intersects_body(a, b)} OR exists(vz_.sa, ve_ -> exists(vz_.sb, vf_ -> {seg_d2} <= {d2})))')} END")


def contains_sql(a: str, b: str, rect_only: bool = False) -> str:
    """ST_Contains(a, b) for polygonal b with positive area."""
    return (f"({b}.area > 0 AND {a}.xmin <= {b}.xmin AND {b}.xmax <= {a}.xmax"
            f" AND {a}.ymin <= {b}.ymin AND {b}.ymax <= {a}.ymax"
            f" AND {overlap_area_sql(a, b, rect_only)} >= {b}.area - 1e-9 * greatest({b}.area, 1D))")


def overlap_area(a: str, b: str, rect_only: bool = False) -> Column:
    return F.expr(overlap_area_sql(a, b, rect_only))


def intersects(a: str, b: str, rect_only: bool = False) -> Column:
    return F.expr(intersects_sql(a, b, rect_only))


def dwithin(a: str, b: str, d: float, rect_only: bool = False) -> Column:
    return F.expr(dwithin_sql(a, b, d, rect_only))


def contains(a: str, b: str, rect_only: bool = False) -> Column:
    return F.expr(contains_sql(a, b, rect_only))


# ---------------------------------------------------------------------------
# CRS
# ---------------------------------------------------------------------------

def is_wgs84(g: str) -> Column:
    """abs(x of a vertex) <= 200 -> degrees (WGS84); LV95 eastings are ~2.5e6."""
    return F.expr(f"abs({g}[0][0][0].x) <= 200")


def _wgs84_to_lv95_point(p: str) -> str:
    # Published swisstopo approximate formulas (about 1 m accuracy):
    # auxiliary values in units of 10000", then polynomial in (phi', lambda').
    phi = f"(({p}.y * 3600 - 169028.66) / 10000)"
    lam = f"(({p}.x * 3600 - 26782.5) / 10000)"
    e = (f"(2600072.37 + 211455.93 * {lam} - 10938.51 * {lam} * {phi}"
         f" - 0.36 * {lam} * {phi} * {phi} - 44.54 * {lam} * {lam} * {lam})")
    n = (f"(1200147.07 + 308807.95 * {phi} + 3745.25 * {lam} * {lam}"
         f" + 76.63 * {phi} * {phi} - 194.56 * {lam} * {lam} * {phi} + 119.79 * {phi} * {phi} * {phi})")
    return f"named_struct('x', {e}, 'y', {n})"


def to_lv95(g: str) -> Column:
    """Transform a WGS84 multipolygon to LV95; LV95 input passes through."""
    conv = f"transform({g}, vpt_ -> transform(vpt_, vrt_ -> transform(vrt_, vq_ -> {_wgs84_to_lv95_point('vq_')})))"
    return F.expr(f"CASE WHEN abs({g}[0][0][0].x) <= 200 THEN {conv} ELSE {g} END")
