"""Mixing sources to target weights along a curriculum that varies over training (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.llm.tables import free, keep, numbered, partitions

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources, by code point and repeating.
WEIGHTS = (1, 2, 3)
#: Rate of a source at the start of training, against its mean rate, by its place in WEIGHTS.
#: It falls or rises evenly to 2 minus this value, so that the mean stays 1.
STARTS = (1.5, 1.0, 0.5)
#: No source is taken more often than this.
REPEATS = 3
SEED = 29


def schedule(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    starts: tuple = STARTS,
    repeats: int = REPEATS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: tuple = (),
) -> DataFrame:
    """Plans which words of which document training sees, and when.

    A source's target is its weight's share of all words, at most ``repeats`` times its own
    words; what is cut off is shared again by weight until no target is above. Each source is
    read in a seeded order, over again where its target asks for it, up to its target to the
    word: the reading ends inside at most one document of each source. A source's rate along
    training, from 0 to 1, is its target times an even ramp; the integral of the ramp is
    inverted at the words read before a copy to give the copy's position.

    Returns one row per document: doc_id, source, size (words), source_size, weight, target,
    taken (words, repeats counted), positions (one for each copy that starts). Null texts have
    size 0 and are taken 0 words. A null source is the last source. Repeated rows are planned
    one by one, an empty table gives no rows, other columns are ignored but for those named in
    ``carry``, which are passed on. Running sums come from
    a range shuffle, so a source with a third of all rows is read by many tasks.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("size"),
        F.md5(
            F.concat_ws(
                ":", F.lit(str(seed)), F.col(f"`{doc_id}`").cast("string"), F.md5(whole.cast("binary"))
            ).cast("binary")
        ).alias("_mix"),
        *carry,
    )
    order = [F.asc_nulls_last("source"), F.col("_mix"), F.col("doc_id"), F.col("size")]
    read = keep(numbered(rows, order, "_at", running="size"), "read")
    sources = read.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.min("_at_sum").alias("_first")
    )
    named = [f"struct({w} as w, {float(a)!r}D as a)" for w, a in zip(weights, starts, strict=True)]
    pick = F.expr(f"array({', '.join(named)})[cast(_nth % {len(weights)} as int)]")
    sources = numbered(sources, [F.asc_nulls_last("source")], "_nth").select(
        "source", "source_size", "_first", pick.alias("_pick")
    )
    sources = keep(
        sources.select(
            F.col("source").alias("_source"),
            "source_size",
            "_first",
            F.col("_pick.w").cast("long").alias("weight"),
            F.col("_pick.a").alias("_start"),
            (F.col("source_size") * repeats).alias("_most"),
        ),
        "sources",
    )
    each = _share(sources)
    target = F.least(F.col("_most").cast("double"), F.lit(each) * F.col("weight"))
    joined = read.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "weight",
        target.alias("target"),
        "_start",
        (F.col("_at_sum") - F.col("_first")).alias("_before"),
        *carry,
    )
    some = F.col("source_size") > 0
    rounds = F.when(some, F.expr("floor(target) div source_size")).otherwise(0)
    planned = joined.withColumn("_rounds", rounds).withColumn(
        "_rest",
        F.expr("least(size, greatest(0L, floor(target) - _rounds * source_size - _before))"),
    )
    copies = F.expr("_rounds + if(_rest > 0, 1, 0)")
    # The integral of a + (b - a) t is a t + (b - a) t^2 / 2, with b = 2 - a; solved for t.
    position = F.expr(
        "transform(if(_copies > 0, sequence(0L, _copies - 1), array()), c -> "
        "2 * ((c * source_size + _before) / target) / (_start + sqrt(greatest(0D, _start * _start"
        " + 2 * (2 - 2 * _start) * ((c * source_size + _before) / target)))))"
    )
    return planned.withColumn("_copies", copies).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "weight",
        "target",
        (F.col("_rounds") * F.col("size") + F.col("_rest")).alias("taken"),
        position.alias("positions"),
        *carry,
    )


def _share(sources: DataFrame) -> float:
    """Words for each unit of weight, when sources that reach their most are set to it.

    A round takes one row of sums to the driver; a source that has reached its most stays there,
    so the rounds end, in practice after a few.
    """
    whole = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not whole[0]:
        return 0.0
    each, left = whole[0] / whole[1], None
    while True:
        full = F.col("_most").cast("double") <= F.lit(each) * F.col("weight")
        capped, weight = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("_most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if not weight or left == (capped, weight):
            return each
        left, each = (capped, weight), (whole[0] - capped) / weight


def curriculum(docs: DataFrame, position: str = "position", **options) -> DataFrame:
    """The documents as training reads them: one row per copy, range-sorted by position.

    All columns of ``docs`` plus the position, by a name that must not be among them; options as
    in ``schedule``. A document taken n times has n rows, one that the mix leaves out has none. The
    document of a source inside which its reading ends is given whole. Rows are told apart by a
    number written with them, so repeated rows are planned and copied one by one.
    """
    doc = free("_doc", [*docs.columns, position])
    rows = keep(docs.withColumn(doc, F.monotonically_increasing_id()), "documents")
    plan = schedule(rows, carry=(doc,), **options)
    copies = plan.select(doc, F.explode("positions").alias(position))
    mixed = rows.join(copies, doc)
    return mixed.repartitionByRange(partitions(docs.sparkSession), position, doc).sortWithinPartitions(
        position, doc
    ).drop(doc)
