"""Chat formatting of logged conversations after collapsing cumulative snapshots (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from breakwater.llm.tables import HOT_SHARE, attach, discard, keep, numbered

#: Turns in one block: of the running hash, and of rendered text.
BLOCK = 256
START, END = "<|im_start|>", "<|im_end|>\n"
#: Role of a turn that names none.
NO_ROLE = "unknown"


def placed(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Each turn with its place ``_at`` in the order of the whole table, and two hashes of what is said.

    Returns conv_id, role, text, h1, h2, _at, written once; later plans read of it what they need.
    Turns of a conversation follow each other by turn, ties by role, then text, nulls first.
    """
    # Null and empty differ: a null adds nothing to a hash, so a flag goes with each value.
    said = [F.col("role"), F.col("role").isNull(), F.col("text"), F.col("text").isNull()]
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("_turn"),
        F.col(f"`{role}`").cast("string").alias("role"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    rows = rows.withColumn("h1", F.xxhash64(F.lit(1), *said)).withColumn("h2", F.xxhash64(F.lit(2), *said))
    return numbered(rows, [F.col(c) for c in ("conv_id", "_turn", "role", "text")], "_at").drop("_turn")


def sizes(rows: DataFrame) -> DataFrame:
    """conv_id, first (place of its first turn in the whole table) and turns of each conversation of ``placed``."""
    return keep(
        rows.groupBy("conv_id").agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("turns")), "sizes"
    )


def prefixes(rows: DataFrame, conversations: DataFrame, total: int) -> DataFrame:
    """Each turn of ``placed`` with the hash of its conversation up to and with it.

    The hash is rolled along the turns: two 64-bit hashes of place, role and text are XORed onto
    those before. Places come from a range shuffle and the rolling goes in blocks, so that a
    conversation with a third of all turns is hashed by many tasks. No text is read here.
    Returns conv_id, first, turns, place (from 0 in the conversation), h1, h2.
    """
    sized = attach(rows.select("conv_id", "_at", "h1", "h2"), conversations, ["conv_id"], "turns", total)
    said = [F.col("_at") - F.col("first"), F.col("h1"), F.col("h2")]
    light = keep(
        sized.select(
            "conv_id",
            "first",
            "turns",
            said[0].alias("place"),
            F.expr(f"(_at - first) div {BLOCK}L").alias("_block"),
            F.xxhash64(F.lit(1), *said).alias("h1"),
            F.xxhash64(F.lit(2), *said).alias("h2"),
        ),
        "turns",
    )
    before = Window.partitionBy("_conv").orderBy("_at_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        light.groupBy(F.col("conv_id").alias("_conv"), F.col("_block").alias("_at_block"))
        .agg(F.bit_xor("h1").alias("_x1"), F.bit_xor("h2").alias("_x2"))
        .select(
            "_conv",
            "_at_block",
            F.coalesce(F.bit_xor("_x1").over(before), F.lit(0)).alias("_b1"),
            F.coalesce(F.bit_xor("_x2").over(before), F.lit(0)).alias("_b2"),
        )
    )
    inside = Window.partitionBy("conv_id", "_block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = keep(
        light.join(
            blocks,
            F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_block") == F.col("_at_block")),
        )
        .withColumn("h1", F.bit_xor("h1").over(inside).bitwiseXOR(F.col("_b1")))
        .withColumn("h2", F.bit_xor("h2").over(inside).bitwiseXOR(F.col("_b2")))
        .select("conv_id", "first", "turns", "place", "h1", "h2"),
        "prefixes",
    )
    discard(light)
    return rolled


def longest(rolled: DataFrame) -> DataFrame:
    """conv_id, first and turns of the conversations that no longer conversation begins with; of equal ones,
    the smallest id stays (null is the smallest)."""
    last = F.col("place") == F.col("turns") - 1
    own = F.struct("conv_id", "first", "turns")
    whole = rolled.where(last).groupBy("place", "h1", "h2").agg(F.min_by(own, _null_first("conv_id")).alias("_kept"))
    # One row for each prefix, however many conversations share it.
    longer = rolled.where(~last).groupBy("place", "h1", "h2").agg(F.count(F.lit(1)).alias("_n"))
    return keep(whole.join(longer, ["place", "h1", "h2"], "left_anti").select("_kept.*"), "longest")


def _kept_turns(turns: DataFrame, **columns: str) -> list[DataFrame]:
    """Turns of maximal conversations: those of hot conversations, then the others.

    The first meet their conversations by broadcast (there are fewer than ``HOT_SHARE`` of them), the others in
    one shuffle by ``_conv``, which gathers a conversation as well. A struct equals another with a null in the same place.
    """
    rows = placed(turns, **columns)
    conversations, total = sizes(rows), rows.count()
    rolled = prefixes(rows, conversations, total)
    kept = longest(rolled).withColumn("_conv", F.struct("conv_id")).drop("conv_id")
    discard(rolled)
    is_hot = F.col("turns") * HOT_SHARE > total
    hot = conversations.where(is_hot).select(F.struct("conv_id").alias("_conv"))
    said = rows.select(F.struct("conv_id").alias("_conv"), "role", "text", "_at")
    parts = [
        said.join(F.broadcast(kept.where(is_hot)), "_conv"),
        said.join(F.broadcast(hot), "_conv", "left_anti").join(kept.where(~is_hot), "_conv"),
    ]
    return [p.withColumn("place", F.col("_at") - F.col("first")).drop("_at", "first") for p in parts]


def maximal(turns: DataFrame, **columns: str) -> DataFrame:
    """The turns of maximal conversations: conv_id, role, text, place (from 0), turns (in the
    conversation). Columns as ``placed``, which conversations stay as ``longest``."""
    hot, cold = _kept_turns(turns, **columns)
    return hot.unionByName(cold).select("_conv.conv_id", "role", "text", "place", "turns")


def _null_first(column: str):
    return F.struct(F.col(column).isNotNull(), F.col(column))


def render(turns: DataFrame, **columns: str) -> DataFrame:
    """Maximal conversations as chat text, one row for each 256 turns.

    Returns conv_id, part (from 0), turns (in the conversation), n_chars, text: for each turn
    ``<|im_start|>role``, a line end, the text and ``<|im_end|>`` with a line end. A null role
    is written "unknown", a null text is empty; a conversation without rows doesn't exist, an
    empty table gives no rows, other columns are ignored, repeated rows are turns of their own.
    Parts in order make up the conversation; it is cut so that no task gathers more turns.
    """
    said = F.concat(
        F.lit(START),
        F.coalesce("role", F.lit(NO_ROLE)),
        F.lit("\n"),
        F.coalesce("text", F.lit("")),
        F.lit(END),
    )
    texts = [
        rows.groupBy("_conv", F.expr(f"cast(place div {BLOCK}L as int)").alias("part"))
        .agg(
            F.max("turns").alias("turns"),
            F.sort_array(F.collect_list(F.struct("place", said.alias("said")))).alias("_all"),
        )
        .select("_conv.conv_id", "part", "turns", F.array_join("_all.said", "").alias("text"))
        for rows in _kept_turns(turns, **columns)
    ]
    return (
        texts[0]
        .unionByName(texts[1])
        .select("conv_id", "part", "turns", F.char_length("text").cast("long").alias("n_chars"), "text")
    )
