"""Fact loads: typed renames from staging, anti-join appends, seed loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_timestamp, day_of, open_end

# staging column -> fact column (positional insert-select of the source)
TRANSACTION_RENAMES = (("transaction_id", "trans_id"), ("transaction_date", "trans_date"),
                       ("card_num", "card_num"), ("oper_type", "opertype"),
                       ("amount", "amt"), ("oper_result", "oper_result"),
                       ("terminal", "terminal"))
BLACKLIST_RENAMES = (("passport", "passport_num"), ("date", "entry_dt"))


def rename(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.col(src).alias(dst) for src, dst in pairs])


def load_transactions(staging: DataFrame) -> DataFrame:
    """Staging transactions in fact layout plus the ``trans_dt`` partition
    column. No de-duplication: the same id loaded twice stays twice."""
    return rename(staging, TRANSACTION_RENAMES).withColumn("trans_dt", day_of("trans_date"))


def append_new(fact: DataFrame, batch: DataFrame, *, batch_key: str = "passport",
               fact_key: str = "passport_num",
               renames: Sequence[tuple[str, str]] = BLACKLIST_RENAMES) -> DataFrame:
    """Batch rows whose key is not yet in the fact (LEFT ANTI join).

    Duplicates inside the batch are all kept and a NULL key never matches, so
    a NULL passport is appended again on every load (source behaviour)."""
    known = fact.select(F.col(fact_key).alias("_known"))
    fresh = batch.join(known, F.col(batch_key) == F.col("_known"), "left_anti")
    return rename(fresh, renames)


def seed_to_hist(seed: DataFrame, *, from_col: str = "create_dt",
                 drop: Sequence[str] = ("create_dt", "update_dt")) -> DataFrame:
    """A seed table as a first dimension version: open from its creation date."""
    keep = [c for c in seed.columns if c not in drop]
    return seed.select(*keep, as_timestamp(F.col(from_col)).alias("effective_from"),
                       open_end().alias("effective_to"), F.lit(0).alias("deleted_flg"))
