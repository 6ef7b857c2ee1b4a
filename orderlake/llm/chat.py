"""Chat formatting with Spark expressions only.

A block of the output is ``<s>role[INST]text</s>``; adjacent turns of one role
share a block, their texts parted by ``[/INST]``. Inside roles and texts ``~``,
``<`` and ``[`` are written ``~0``, ``~1`` and ``~2``, so no control string can
appear there, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, HEAD, PART, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
CHUNK_TURNS = 64
TRAINED = "assistant"


def escape(c: Column) -> Column:
    for raw, safe in (("~", "~0"), ("<", "~1"), ("[", "~2")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for raw, safe in (("[", "~2"), ("<", "~1"), ("~", "~0")):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def _merged(turns: Column) -> Column:
    """Sorted turns as blocks: adjacent turns of one role become one."""
    block = "array<struct<role:string,texts:array<string>>>"

    def add(blocks: Column, turn: Column) -> Column:
        last = F.element_at(blocks, -1)
        grown = F.struct(
            turn["role"].alias("role"),
            F.concat(last["texts"], F.array(turn["text"])).alias("texts"),
        )
        new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        same = (F.size(blocks) > 0) & (F.try_element_at(blocks, F.lit(-1))["role"] == turn["role"])
        return F.when(
            same, F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), F.array(grown))
        ).otherwise(F.concat(blocks, F.array(new))).cast(block)

    return F.aggregate(turns, F.array().cast(block), add)


def format_chats(conversations: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments``.

    ``segments`` holds the output cut into ``text, loss``; joined they are
    ``formatted``, and ``loss`` marks exactly the texts of assistant turns.

    Turns sort by ``turn``, then role, then text; a missing turn number comes
    first. A missing role or text counts as empty, repeated rows are turns of
    their own, a missing ``conv_id`` is a conversation, other columns are
    ignored, and an empty table gives no rows. Turns are sorted and merged in
    chunks of ``chunk_turns`` turn numbers before a conversation is put
    together, so a very long one is not sorted in one group.
    """
    rows = conversations.select(
        F.col("conv_id"),
        F.floor(F.col("turn") / F.lit(chunk_turns)).alias("chunk"),
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("item"),
    )
    chunks = rows.groupBy("conv_id", "chunk").agg(
        _merged(F.sort_array(F.collect_list("item"))).alias("blocks")
    )
    whole = chunks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "blocks"))).alias("chunks")
    ).select("conv_id", F.flatten(F.col("chunks.blocks")).alias("blocks"))

    def segments(block: Column, i: Column) -> Column:
        before = F.get(F.col("blocks"), i - 1)["role"]
        starts = (i == 0) | (before != block["role"])
        closing = F.when(i > 0, F.lit(CLOSE)).otherwise(F.lit(""))
        mark = F.when(
            starts, F.concat(closing, F.lit(OPEN), escape(block["role"]), F.lit(HEAD))
        ).otherwise(F.lit(PART))
        loss = block["role"] == TRAINED
        return F.flatten(F.transform(
            block["texts"],
            lambda text, k: F.array(
                F.struct(
                    F.when(k == 0, mark).otherwise(F.lit(PART)).alias("text"),
                    F.lit(False).alias("loss"),
                ),
                F.struct(escape(text).alias("text"), loss.alias("loss")),
            ),
        ))

    end = F.array(F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")))
    cut = whole.select(
        "conv_id",
        F.concat(F.flatten(F.transform(F.col("blocks"), segments)), end).alias("segments"),
    )
    return cut.select(
        "conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as ``role, text`` structs."""
    blocks = F.slice(
        F.split(formatted, OPEN, -1), F.lit(2), F.greatest(F.size(F.split(formatted, OPEN, -1)) - 1, F.lit(0))
    )

    def turns(block: Column) -> Column:
        head = F.substring_index(block, HEAD, 1)
        body = F.substring(
            block, F.length(head) + len(HEAD) + 1,
            F.length(block) - F.length(head) - len(HEAD) - len(CLOSE),
        )
        return F.transform(
            F.split(body, r"\[/INST\]", -1),
            lambda text: F.struct(unescape(head).alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def op10_chat(spark, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text"
    )
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    out = format_chats(conversations.unionByName(extra))
    trained = F.filter(F.col("segments"), lambda s: s["loss"])
    loss = F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    read = out.select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"), loss.alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP10_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, lag(role) OVER w AS before,
    length(replace(replace(replace(text, '~', '~0'), '<', '~1'), '[', '~2')) AS chars,
    length(replace(replace(replace(role, '~', '~0'), '<', '~1'), '[', '~2')) AS role_chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN before = role THEN 7 ELSE 13 + role_chars END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""
