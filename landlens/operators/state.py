"""Table-state operators: keyed upsert, replace-by-keys, additive migration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def check_unique(df: DataFrame, key: str) -> None:
    """Raise when a non-null key occurs twice in one batch (ON CONFLICT rule)."""
    dup = (df.where(F.col(key).isNotNull()).groupBy(key).count()
           .where(F.col("count") > 1).limit(1).collect())
    if dup:
        raise DuplicateKeyError(f"duplicate {key} in upsert batch: {dup[0][0]!r}")


def unique_or_error(df: DataFrame, key: str) -> DataFrame:
    """The rows of ``df``; one that repeats a non-null key fails the job that computes it, with the key. No job runs before."""
    names = df.columns
    own = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*names)).alias("_row"))
    message = F.concat(F.lit(f"duplicate {key} in upsert batch: "), F.col(key).cast("string"))
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast(own.schema["_row"].dataType)).otherwise(F.col("_row"))
    return own.select(checked.alias("_row")).select("_row.*").unionByName(df.where(F.col(key).isNull()))


def upsert(old: DataFrame, new: DataFrame, key: str, update: Sequence[str],
           check: bool | str = True) -> DataFrame:
    """INSERT new ON CONFLICT(key) DO UPDATE SET <update>.

    * keys only in ``old`` are kept unchanged (absent parcels are retained);
    * matched keys take ``update`` columns from ``new`` (even when NULL) and
      keep every other column (stable ids, first_seen, enrichment);
    * keys only in ``new`` and all NULL-key rows of ``new`` are inserted with
      the columns ``new`` has (others NULL), NULL-key rows of ``old`` stay.

    A key given twice in ``new`` is an error: raised here (``check=True``, one job) or inside the plan (``check="plan"``).
    """
    if check == "plan":
        new = unique_or_error(new, key)
    elif check:
        check_unique(new, key)
    cols = list(old.columns)
    for c in new.columns:
        if c not in cols:
            cols.append(c)
    o = old.select(*[F.col(c).alias(f"o_{c}") if c in old.columns else F.lit(None).alias(f"o_{c}")
                     for c in cols])
    n = new.select(*[F.col(c).alias(f"n_{c}") if c in new.columns else F.lit(None).alias(f"n_{c}")
                     for c in cols])
    j = (o.where(F.col(f"o_{key}").isNotNull())
         .join(n.where(F.col(f"n_{key}").isNotNull()),
               F.col(f"o_{key}") == F.col(f"n_{key}"), "full_outer"))
    in_old, in_new = F.col(f"o_{key}").isNotNull(), F.col(f"n_{key}").isNotNull()
    sel = []
    for c in cols:
        if c == key:
            sel.append(F.coalesce(F.col(f"o_{c}"), F.col(f"n_{c}")).alias(c))
        elif c in update:
            sel.append(F.when(in_new, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c))
        else:
            sel.append(F.when(in_old, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c))
    keyed = j.select(*sel)
    null_old = o.where(F.col(f"o_{key}").isNull()).select(*[F.col(f"o_{c}").alias(c) for c in cols])
    null_new = n.where(F.col(f"n_{key}").isNull()).select(*[F.col(f"n_{c}").alias(c) for c in cols])
    return keyed.unionByName(null_old).unionByName(null_new)


def replace_keys(old: DataFrame, new: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """DELETE WHERE key = ANY(keys); INSERT the new rows of those keys."""
    k = keys.select(key).distinct()
    return old.join(k, key, "left_anti").unionByName(new.join(k, key, "left_semi"))


def migrate(df: DataFrame, columns: Mapping[str, tuple[str, object]]) -> DataFrame:
    """ADD COLUMN IF NOT EXISTS name type DEFAULT value, for every missing column."""
    out = df
    for name, (typ, default) in columns.items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(default).cast(typ))
    return out


def update_from(target: DataFrame, source: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """UPDATE target SET col = source.src_col FROM source WHERE source.key = target.key.

    Unmatched target rows keep their previous values; ``source`` must be unique
    on ``key`` (as the source pipeline's DISTINCT ON guarantees).
    """
    src = source.select(F.col(key).alias("_k"), F.lit(True).alias("_hit"),
                        *[F.col(s).alias(f"_new_{t}") for t, s in columns.items()])
    j = target.join(src, target[key] == src["_k"], "left")
    for t in columns:
        j = j.withColumn(t, F.when(F.col("_hit"), F.col(f"_new_{t}")).otherwise(F.col(t)))
    return j.drop("_k", "_hit", *[f"_new_{t}" for t in columns])
