"""Trade attributes for breaks: FO first, BO where FO does not know the trade, then fixed defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import any_null
from breakwater.operators.sieve import sifted
from breakwater.operators.skew import DEFAULT, REPEATED, SALT, SkewPolicy, salted, salted_lookup

ATTRIBUTES = list(C.ENRICHMENT_DEFAULTS)


def _keys(run_col: str | None) -> list[str]:
    return [run_col, "Trade_ID"] if run_col else ["Trade_ID"]


def known_attributes(
    breaks: DataFrame,
    front: DataFrame,
    back: DataFrame,
    run_col: str | None = None,
    attributes: Sequence[str] = tuple(ATTRIBUTES),
    every_copy: bool = False,
    policy: SkewPolicy | None = DEFAULT,
) -> DataFrame:
    """Attributes of the trades that have breaks, NULL where neither feed knows one.

    One row per key by default. The BO feed is only searched for the trades FO does not know in
    full, and the copies of such a trade are reduced to the smallest one. ``every_copy`` keeps the
    distinct BO variants apart and counts the BO rows behind each result row in ``Row_Copies``; that
    is the bag a plain join with all BO rows would give, without writing it out.

    Feed rows of other trades are sifted out before anything is shuffled. The keys are joined without a
    hint, hot BO keys salted: the engine broadcasts what it measures to be small.
    """
    keys = _keys(run_col)
    attributes = list(attributes)
    wanted = breaks.select(*keys).filter(~any_null(keys)).distinct()

    fo, bo = [sifted(feed.select(*keys, *attributes), wanted, keys) for feed in (front, back)]
    # Read twice: as a result, and to find the trades FO does not know in full. Both need the same
    # columns after the same shuffle, so FO is shuffled once.
    from_fo = wanted.join(fo, keys, "left")
    searched = wanted if every_copy else from_fo.filter(any_null(attributes)).select(*keys)
    ids = back.select(*keys).filter(~any_null(keys))
    many, one, on = salted(bo.filter(~any_null(keys)), searched, keys, policy, like=ids)
    bo = many.join(one, on).drop(SALT, REPEATED)

    variant = bo.select(*keys, F.struct(*attributes).alias("_bo"))
    if every_copy:
        from_bo = variant.groupBy(*keys, "_bo").agg(F.count(F.lit(1)).alias("_copies"))
    else:
        from_bo = variant.groupBy(*keys).agg(F.min("_bo").alias("_bo"))
    known = from_fo.join(from_bo, keys, "left").select(
        *keys,
        *[F.coalesce(F.col(a), F.col(f"_bo.{a}")).alias(a) for a in attributes],
        *([F.coalesce(F.col("_copies"), F.lit(1)).alias("_copies")] if every_copy else []),
    )
    if every_copy:
        # BO variants that look alike once FO has been filled in are one row again.
        known = known.groupBy(*keys, *attributes).agg(F.sum("_copies").alias("Row_Copies"))
    return known


def enrich(
    breaks: DataFrame,
    front: DataFrame,
    back: DataFrame,
    run_col: str | None = None,
    every_copy: bool = False,
    policy: SkewPolicy | None = DEFAULT,
) -> DataFrame:
    """Breaks with their trade attributes.

    Feeds carry their run (or period), so a break is only ever enriched from the feeds of its own
    run. Ids with very many breaks are salted.
    """
    keys = _keys(run_col)
    known = known_attributes(breaks, front, back, run_col, every_copy=every_copy, policy=policy)
    joined = salted_lookup(breaks, known, keys, "left", policy)
    filled = [F.coalesce(F.col(a), F.lit(default)).alias(a) for a, default in C.ENRICHMENT_DEFAULTS.items()]
    # A break whose trade is unknown stands for itself.
    copies = [F.coalesce(F.col("Row_Copies"), F.lit(1)).alias("Row_Copies")] if every_copy else []
    return joined.select(*breaks.columns, *filled, *copies)
