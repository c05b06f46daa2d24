"""Preference formatting: pairs of conversations as one prompt and two masked completions.

``preference_pairs`` takes turns of chosen and of rejected conversations with a common
``pair_id``. A pair's longest common prefix of turns (equal role and text) is rendered once
as the prompt; the remaining turns of either side are its completion. A completion's mask
lists the character ranges to learn from, ``start:end`` in code points of the completion,
joined by commas: the texts of assistant turns with the mark that ends them.

Turns are taken in the order of turn, role, text; null turn numbers come first and repeated
rows count as turns. A null role is ``unknown``, a null text is empty. A pair with one side
only has an empty prompt and an empty other completion. Null pair_ids form one pair. Other
columns are not read. A pair is one row of the output, so its turns meet in one task.

Everything is a DataFrame expression.
"""
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_START, _ROLE_END, _TURN_END = "<|", "|>\n", "<|end|>\n"
_LEARNED_ROLE = "assistant"


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(_START), turn["role"], F.lit(_ROLE_END), turn["text"], F.lit(_TURN_END))


def _text_of(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask_of(turns: Column) -> Column:
    """Ranges of the learned texts, by a running sum of the rendered lengths."""
    head = len(_START) + len(_ROLE_END)

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + head + F.length(turn["role"])
        end = start + F.length(turn["text"]) + len(_TURN_END)
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        learned = turn["role"] == _LEARNED_ROLE
        return F.struct(
            end.alias("at"),
            F.when(learned, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, start, step, lambda state: F.array_join(state["spans"], ","))


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``pair_id, n_common, prompt, chosen, chosen_mask, rejected, rejected_mask``.

    Both inputs have ``pair_id, turn, role, text``. One shuffle, by ``pair_id``.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        turn = F.struct(
            "turn",
            F.coalesce("role", F.lit("unknown")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        return df.select("pair_id", F.lit(name).alias("side"), turn.alias("turn"))

    def turns(name: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("side") == name, F.col("turn")))).alias(name)

    sides = (
        side(chosen, "chosen")
        .unionByName(side(rejected, "rejected"))
        .groupBy("pair_id")
        .agg(turns("chosen"), turns("rejected"))
    )
    same = F.zip_with(
        "chosen",
        "rejected",
        lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]),
    )
    # past the shorter side's end a missing turn is compared with a turn, which differs
    first_difference = F.array_position(same, False)
    n_common = F.when(first_difference == 0, F.size("chosen")).otherwise(first_difference - 1)
    pairs = sides.withColumn("n_common", n_common.cast("int"))
    prompt = F.slice("chosen", F.lit(1), F.col("n_common"))
    rest = {name: F.slice(name, F.col("n_common") + 1, F.size(name)) for name in ("chosen", "rejected")}
    return pairs.select(
        "pair_id",
        F.col("n_common").cast("long").alias("n_common"),
        _text_of(prompt).alias("prompt"),
        _text_of(rest["chosen"]).alias("chosen"),
        _mask_of(rest["chosen"]).alias("chosen_mask"),
        _text_of(rest["rejected"]).alias("rejected"),
        _mask_of(rest["rejected"]).alias("rejected_mask"),
    )


def borrowed_replies(conversations: DataFrame) -> DataFrame:
    """Rejected turns for conversations: the last reply is another conversation's.

    Conversations 2k and 2k + 1 lend each other their last assistant turn; all other turns
    stay. Without a reply on either side nothing is replaced. ``pair_id`` is the conv_id.
    """
    turn = ["turn", "role", "text"]
    last = (
        conversations.filter(F.col("role") == _LEARNED_ROLE)
        .groupBy("conv_id")
        .agg(F.max(F.struct(F.col("turn").alias("last_turn"), F.col("text").alias("reply"))).alias("last"))
    )
    own = last.select("conv_id", F.col("last.last_turn").alias("last_turn"))
    lent = last.select(
        F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("last.reply").alias("reply")
    )
    replaced = own.join(lent, "conv_id")
    return (
        conversations.select("conv_id", *turn)
        .join(replaced, "conv_id", "left")
        .withColumn(
            "text",
            F.when(
                (F.col("turn") == F.col("last_turn")) & (F.col("role") == _LEARNED_ROLE), F.col("reply")
            ).otherwise(F.col("text")),
        )
        .select(F.col("conv_id").alias("pair_id"), *turn)
    )


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with a borrowed last reply."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    chosen = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    return preference_pairs(chosen, borrowed_replies(conversations))


PREFERENCE_SQL = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
    FROM conversations
),
last_reply AS (
    SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS reply
    FROM turns WHERE role = 'assistant' GROUP BY conv_id
),
both_sides AS (
    SELECT own.conv_id, own.last_turn, lent.reply
    FROM last_reply own JOIN last_reply lent ON lent.conv_id = xor(own.conv_id, 1)
),
compared AS (
    SELECT t.conv_id, t.turn, t.role, t.text AS c_text,
        CASE WHEN t.turn = b.last_turn AND t.role = 'assistant' THEN b.reply ELSE t.text END AS r_text
    FROM turns t LEFT JOIN both_sides b ON t.conv_id = b.conv_id
),
cut AS (
    SELECT *, coalesce(min(CASE WHEN c_text <> r_text THEN turn END) OVER (PARTITION BY conv_id),
        9223372036854775807) AS first_difference
    FROM compared
),
rendered AS (
    SELECT *, turn < first_difference AS common,
        '<|' || role || '|>' || chr(10) || c_text || '<|end|>' || chr(10) AS c_line,
        '<|' || role || '|>' || chr(10) || r_text || '<|end|>' || chr(10) AS r_line
    FROM cut
),
placed AS (
    SELECT *,
        sum(length(c_line)) OVER (PARTITION BY conv_id, common ORDER BY turn) AS c_end,
        sum(length(r_line)) OVER (PARTITION BY conv_id, common ORDER BY turn) AS r_end
    FROM rendered
)
SELECT conv_id AS pair_id,
    count(*) FILTER (common) AS n_common,
    coalesce(string_agg(c_line, '' ORDER BY turn) FILTER (common), '') AS prompt,
    coalesce(string_agg(c_line, '' ORDER BY turn) FILTER (NOT common), '') AS chosen,
    coalesce(string_agg((c_end - length(c_text) - 8) || ':' || c_end, ',' ORDER BY turn)
        FILTER (NOT common AND role = 'assistant'), '') AS chosen_mask,
    coalesce(string_agg(r_line, '' ORDER BY turn) FILTER (NOT common), '') AS rejected,
    coalesce(string_agg((r_end - length(r_text) - 8) || ':' || r_end, ',' ORDER BY turn)
        FILTER (NOT common AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY conv_id
"""
