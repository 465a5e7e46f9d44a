"""Dialogues rendered once from every participant's point of view."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.position import number_rows

SYSTEM = "system"
NOBODY = "unknown"


def rotate(
    turns: DataFrame,
    max_turns: int = 256,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation, perspective and part.

    Every role but ``system`` is a participant.  In the view of a participant
    its own turns are ``assistant`` turns, system turns stay, and all others are
    ``user`` turns that carry the speaker's name.  A turn is rendered as
    ``<|im_start|>assistant``, ``<|im_start|>system`` or ``<|im_start|>user
    name=NAME``, a line break, its text, ``<|im_end|>`` and a line break.

    ``rendered`` is the text of the part and ``spans`` the masks: start:end in
    code points, end exclusive, of what the participant is trained on (its own
    texts with their end marks), comma-joined.  ``trained_chars`` sums them.

    A dialogue of more than ``max_turns`` turns is cut into parts of that many,
    so no row or task gathers a whole hot conversation; parts are numbered from
    0 and hold consecutive turns.  Turns follow ``turn`` (null first), ties
    follow role and text; equal rows are both kept.  A null or empty role is
    the participant ``unknown``, a null text is empty, rows with a null
    conversation form one dialogue.  A dialogue of system turns only has no
    participant and no row.  Other columns are ignored.
    """
    speaker = F.when(F.coalesce(F.col(role), F.lit("")) == "", NOBODY).otherwise(F.col(role))
    rows = turns.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("at"),
        speaker.alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("said"),
    )
    order = [F.col("at").asc_nulls_first(), F.col("speaker"), F.col("said")]
    numbered = number_rows(rows, ["conv"], order, "position")
    views = rows.where(F.col("speaker") != SYSTEM).select(F.col("conv").alias("of"), F.col("speaker").alias("perspective"))
    seen = numbered.join(views.distinct(), F.col("conv").eqNullSafe(F.col("of")))
    own = F.col("speaker") == F.col("perspective")
    head = (
        F.when(own, F.lit("<|im_start|>assistant\n"))
        .when(F.col("speaker") == SYSTEM, F.lit("<|im_start|>system\n"))
        .otherwise(F.concat(F.lit("<|im_start|>user name="), F.col("speaker"), F.lit("\n")))
    )
    body = F.concat(F.col("said"), F.lit("<|im_end|>"))
    message = F.struct(
        "position",
        F.concat(head, body, F.lit("\n")).alias("message"),
        F.char_length(head).alias("head"),
        F.char_length(body).alias("body"),
        own.alias("own"),
    )
    part = F.expr(f"(position - 1) div {int(max_turns)}")
    parts = seen.groupBy("conv", "perspective", part.alias("part")).agg(
        F.sort_array(F.collect_list(message)).alias("messages")
    )
    # Bounded by max_turns: where each message starts, then the spans of the own ones.
    walked = F.aggregate(
        "messages",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).cast("long").alias("chars")),
        lambda a, m: F.struct(
            (a["at"] + F.char_length(m["message"])).alias("at"),
            F.when(
                m["own"],
                F.concat(a["spans"], F.array(F.concat_ws(":", a["at"] + m["head"], a["at"] + m["head"] + m["body"]))),
            ).otherwise(a["spans"]).alias("spans"),
            (a["chars"] + F.when(m["own"], m["body"]).otherwise(0)).alias("chars"),
        ),
    )
    return parts.withColumn("walked", walked).select(
        F.col("conv").alias(conversation),
        "perspective",
        F.col("part").cast("long").alias("part"),
        F.size("messages").cast("long").alias("n_turns"),
        F.array_join(F.transform("messages", lambda m: m["message"]), "").alias("rendered"),
        F.array_join("walked.spans", ",").alias("spans"),
        F.col("walked.chars").alias("trained_chars"),
    )
