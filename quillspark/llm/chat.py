"""Chat formatting after cumulative-snapshot collapse, in DataFrame operations only.

A logged conversation that is a prefix of a longer one is a snapshot of it, and only maximal conversations are rendered. The
hash of a prefix is the XOR of its turns' hashes, each over place, role and text, so it combines in any order: hashes roll
within blocks of ``BLOCK`` turns and over the blocks, and no task ever sorts a whole long conversation. Only hashes are
compared; texts are shuffled once, for rendering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turns whose hashes roll together, and turns of one rendered row.
BLOCK, CHUNK = 1024, 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: A null turn comes before all others.
FIRST = -(2**63)


def _hashed(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, a, b: 128 bits of hash for each turn; rows that are equal in all four columns count once."""
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(FIRST))
    # The two hashes differ in seed by their column order; a null differs from an empty text by its flag.
    marks = [F.isnull("role"), F.isnull("text")]
    each = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", turn.alias("turn"),
        F.xxhash64(turn, "role", "text", *marks).alias("a"), F.xxhash64("text", *marks, "role", turn).alias("b"),
    )
    return each.distinct().groupBy("conv_id", "turn").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))


def prefixes(hashed: DataFrame) -> DataFrame:
    """conv_id, turn, a, b, whole: the hash of each conversation up to and with each of its turns; whole at the last of them."""
    block = F.floor(F.col("turn") / BLOCK)
    held = hashed.withColumn("block", block)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = held.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.max("turn").alias("top"))
    # The last turn of the last block; so no conversation's turns need to meet its length in one task.
    top = F.when(F.isnull(F.lead("block").over(Window.partitionBy("conv_id").orderBy("block"))), F.col("top"))
    blocks = blocks.select("conv_id", "block", top.alias("top"), *(F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"{c}0") for c in "ab"))
    upto = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    rolled = held.select("conv_id", "block", "turn", *(F.bit_xor(c).over(upto).alias(c) for c in "ab"))
    whole = F.coalesce(F.col("turn") == F.col("top"), F.lit(False)).alias("whole")
    return rolled.join(blocks, ["conv_id", "block"]).select("conv_id", "turn", *(F.col(c).bitwiseXOR(F.col(f"{c}0")).alias(c) for c in "ab"), whole)


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id of the conversations that no longer one begins with; of equal ones the smallest conv_id."""
    hashed = _hashed(conversations)
    whole = hashed.groupBy("conv_id").agg(F.max("turn").alias("turn"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    alone = whole.groupBy("turn", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    # What is shorter than its conversation is a proper prefix; equal prefixes of many conversations meet as one row.
    proper = prefixes(hashed).where("not whole").select("turn", "a", "b").distinct()
    return alone.join(proper, ["turn", "a", "b"], "left_anti").select("conv_id")


def chat_format(conversations: DataFrame) -> DataFrame:
    """conv_id, chunk, n_turns, rendered: the maximal conversations in chat markup, ``CHUNK`` turns a row.

    Turns are rendered by turn number (nulls first), ties by role, then text; repeated rows once. A null role is rendered as
    ``user``, a null text as empty, and ``<|`` within role or text is broken up, so that no text can pose as markup. Rows
    without a conv_id are left out; an empty table gives an empty one; further columns are ignored. Different rows of one turn
    number, or of none, stay together in one rendered row, however many they are.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    kept = conversations.join(maximal(conversations), "conv_id", "left_semi")
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(FIRST))
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    groups = kept.groupBy("conv_id", F.floor(turn / CHUNK).alias("chunk")).agg(F.array_sort(F.collect_set(F.struct(turn.alias("turn"), F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    line = lambda t: F.concat(F.lit(OPEN), safe(t["role"]), F.lit("\n"), safe(t["text"]), F.lit(CLOSE + "\n"))
    return groups.select("conv_id", F.col("chunk").cast("long").alias("chunk"), F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", line), "").alias("rendered"))


#: The same in DuckDB, with whole conversations compared as lists.
ORACLE_SQL = """
    WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, -9223372036854775808) AS turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, max(turn) AS last, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn, role, text) AS turns FROM t GROUP BY conv_id),
    alone AS (SELECT min(conv_id) AS conv_id, last, turns FROM c GROUP BY last, turns),
    kept AS (
        SELECT conv_id FROM alone a WHERE NOT EXISTS (
            SELECT 1 FROM c d WHERE d.turns[1] = a.turns[1] AND d.last > a.last AND list_filter(d.turns, lambda x: x.turn <= a.last) = a.turns)
    ),
    r AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM t SEMI JOIN kept USING (conv_id))
    SELECT conv_id, CAST(floor(turn / 256) AS BIGINT) AS chunk, count(*) AS n_turns,
           string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
    FROM r GROUP BY 1, 2
"""
