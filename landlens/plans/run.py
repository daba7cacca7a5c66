"""One stateful parcel run: upsert, enrichment, score, snapshot, change log."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import state as S
from ..session import stage_table
from . import changes as C
from . import parcels as P

#: Columns that a new load overwrites; the others (stable id, first_seen, zone values) stay as they were.
UPDATED = ["source_id", "commune_bfs", "commune_name", "parcel_no", "shape", "area_m2", "last_updated"]
#: Columns that the enrichment and the score replace for parcels of the run.
COMPUTED = ["zone_type", "primary_use", "is_building_zone", "dominant_zone_id", "in_planning_zone", "forest_overlap_m2", "building_footprint_m2",
            "developable_m2", "coverage_ratio", "oereb_checked", "oereb_blocking", "signal_underuse", "signal_servicing", "signal_assembly", "opportunity_score"]


class Run(NamedTuple):
    state: DataFrame
    snapshots: DataFrame
    changes: DataFrame


def parcel_run(prior: DataFrame | None, raw_parcels: DataFrame, zoning: DataFrame, planning: DataFrame, forest: DataFrame, buildings: DataFrame,
               restrictions: DataFrame, snapshots: DataFrame | None, run_id: str, run_ts: str) -> Run:
    """``prior`` / ``snapshots``: what the run before returned (None on the first run). Parcels that the new load lacks stay, with their
    first_seen and parcel_uid; a parcel without any zone keeps the zone values it had."""
    ts = F.lit(run_ts).cast("timestamp_ntz")
    new = (P.base_parcels(raw_parcels).where(F.col("egrid").isNotNull())
           .withColumns({"last_updated": ts, "first_seen": ts, "parcel_uid": F.sha2(F.col("pkey"), 256)}))
    held = S.unique_or_error(new, "egrid") if prior is None else S.upsert(prior, new, "egrid", UPDATED, check="plan")
    # staged: the overlay and the neighbour join count boxes by cell before they run
    base = stage_table(held.select("pkey", "egrid", "source_id", "commune_bfs", "commune_name", "parcel_no", "shape", "area_m2", "first_seen", "last_updated", "parcel_uid"))
    if G.is_rect_only(raw_parcels):
        base = G.mark_rect_only(base)
    enriched = stage_table(P.enrich(base, zoning, planning, forest, buildings, restrictions))
    if G.is_rect_only(base):
        enriched = G.mark_rect_only(enriched)
    scored = P.score(enriched).drop("score_raw", "score_zeroed")
    if prior is not None:  # UPDATE ... FROM leaves rows without a match alone
        zone = ["zone_type", "primary_use", "is_building_zone", "dominant_zone_id"]
        old = prior.select(F.col("egrid").alias("_e"), *[F.col(c).alias(f"_old_{c}") for c in zone])
        scored = scored.join(old, F.col("egrid") == F.col("_e"), "left")
        lost = F.col("dominant_zone_id").isNull()
        scored = scored.withColumns({c: F.when(lost, F.col(f"_old_{c}")).otherwise(F.col(c)) for c in zone}).drop("_e", *[f"_old_{c}" for c in zone])
    scored = stage_table(scored)  # read by the state, the snapshot and the change log
    before = snapshots if snapshots is not None else C.snapshot_rows(scored.where(F.lit(False)), run_id, run_ts)
    found = (C.detect_changes(scored, before).withColumn("detected_at", ts)
             .withColumn("id", F.xxhash64(F.lit(run_id), "egrid")))
    return Run(scored, before.unionByName(C.snapshot_rows(scored, run_id, run_ts)), found.select("id", "egrid", "change_type", "detected_at", "detail"))
