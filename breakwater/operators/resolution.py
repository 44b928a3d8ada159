"""Break resolution as events: actions are appended, history and current state are derived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.operators.skew import DEFAULT, SkewPolicy, previous_value, salted_lookup

ORDER = ["Created_At", "Action_Seq"]


def normalise(actions: DataFrame) -> DataFrame:
    """Upper-cases the status and fills the defaults of a request."""
    # An empty status counts as absent; an empty reason, user or note is a value.
    status = F.upper(F.coalesce(F.nullif(F.col("New_Status"), F.lit("")), F.lit(C.DEFAULT_ACTION["New_Status"])))
    defaults = {n: F.coalesce(F.col(n), F.lit(v)) for n, v in C.DEFAULT_ACTION.items() if n != "New_Status"}
    return actions.withColumns({"New_Status": status, **defaults})


def judge(actions: DataFrame, breaks: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Normalised actions with the trade of their break and a ``Reject_Reason`` (NULL when accepted)."""
    known = breaks.groupBy("Break_ID").agg(F.min("Trade_ID").alias("Trade_ID"), F.lit(True).alias("_known"))
    looked_up = salted_lookup(normalise(actions), known, ["Break_ID"], "left", policy)
    reason = (
        F.when(F.coalesce(F.col("Break_ID"), F.lit("")) == "", "Missing break id")
        .when(~F.col("New_Status").isin(C.RESOLUTION_STATUSES), "Invalid status")
        .when(F.col("_known").isNull(), "Unknown break")
    )
    return looked_up.withColumn("Reject_Reason", reason).drop("_known")


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("Reject_Reason").isNull()).drop("Reject_Reason")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("Reject_Reason").isNotNull())


def history(actions: DataFrame, slices: int | None = None, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Audit trail: every accepted action with the status it replaced."""
    trail = previous_value(
        actions,
        "Break_ID",
        ORDER,
        "New_Status",
        C.RESOLUTION_STATUSES[0],
        "Previous_Status",
        slices=slices,
        policy=policy,
    )
    return trail.select(
        "Break_ID", "Trade_ID", "Previous_Status", "New_Status", "Reason", "Action_By", "Notes", *ORDER
    )


def current_state(
    breaks: DataFrame,
    actions: DataFrame,
    policy: SkewPolicy | None = DEFAULT,
    like: DataFrame | None = None,
) -> DataFrame:
    """Breaks with the outcome of their latest accepted action; UNRESOLVED without one.

    The latest action is found by an aggregate, so many actions on one break combine map-side.
    Missing trades without an id share one key, therefore the salts.
    """
    latest = actions.groupBy("Break_ID").agg(
        F.max(F.struct(*ORDER, "New_Status", "Reason", "Action_By")).alias("_last")
    )
    plain = [c for c in breaks.columns if not c.startswith("Resol")]
    return salted_lookup(breaks, latest, ["Break_ID"], "left", policy, like).select(
        *plain,
        F.coalesce(F.col("_last.New_Status"), F.lit(C.RESOLUTION_STATUSES[0])).alias("Resolution_Status"),
        F.col("_last.Reason").alias("Resolution_Reason"),
        F.col("_last.Action_By").alias("Resolved_By"),
        F.col("_last.Created_At").alias("Resolved_At"),
    )
