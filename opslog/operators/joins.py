"""Join shapes that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preserving_left_join(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str, dim_keys: DataFrame) -> DataFrame:
    """``dim LEFT JOIN fact ON dim_key = fact_key`` for a small preserved side and
    a large, possibly skewed, non-preserved side.

    A plain left outer join can only split (AQE skew handling) or broadcast in
    the wrong direction here: the hot key sits on the side that may not be
    split. So the fact side gets a row of NULLs for every key it lacks and the
    join becomes an inner one, which AQE may broadcast or split either way:

        dim INNER JOIN (fact  UNION ALL  dim_keys LEFT ANTI JOIN distinct fact keys)

    ``dim_keys`` is a one-column frame of the keys ``dim`` may hold (a
    superset is fine, extra keys find no partner); it is read instead of
    ``dim``, whose own columns may be costly, so ``dim`` is evaluated once.
    """
    key = dim_keys.columns[0]
    present = fact.select(F.col(fact_key).alias("__present")).distinct()
    lacking = (dim_keys.distinct().join(present, F.col(key) == F.col("__present"), "left_anti")
               .select(F.col(key).alias("__key"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in fact.schema.fields]))
    padded = fact.select(F.col(fact_key).alias("__key"), *fact.columns).unionByName(lacking)
    return dim.join(padded, F.col(dim_key) == F.col("__key"), "inner").drop("__key")


# Rows of one key that may meet in one task of an expanding join.
ROWS_PER_SALT = 100_000


def salted_join(many: DataFrame, few: DataFrame, many_key: str, few_key: str,
                rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``many INNER JOIN few`` on one key, for a join that multiplies rows.

    When a handful of equal keys hold most rows on both sides, no partition
    stands out against the median and adaptive execution splits none. So rows
    of ``many`` are counted per key, a key with more than ``rows_per_salt`` is
    dealt to as many salts, and its rows in ``few`` are repeated once per
    salt. Keys below the limit are joined as they are.
    """
    hot = (many.groupBy(F.col(many_key).alias("__hot")).agg(F.count(F.lit(1)).alias("__rows"))
           .where(F.col("__rows") > rows_per_salt)
           .select("__hot", F.ceil(F.col("__rows") / rows_per_salt).cast("int").alias("__salts")))
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    spread = F.pmod(F.xxhash64(*[F.col(f.name) for f in many.schema.fields]), salts).cast("int")
    left = (many.join(hot, F.col(many_key) == F.col("__hot"), "left")
            .withColumn("__salt", spread).drop("__hot", "__salts"))
    right = (few.join(hot, F.col(few_key) == F.col("__hot"), "left")
             .withColumn("__of", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__hot", "__salts"))
    return left.join(right, (F.col(many_key) == F.col(few_key)) & (F.col("__salt") == F.col("__of"))).drop("__salt", "__of")
