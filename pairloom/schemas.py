"""Fixed schemas of every table that crosses a file boundary."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields):
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _L, _B, _D = StringType(), LongType(), BooleanType(), DoubleType()

# Dump attributes are text in the file; `BIGINT_FIELDS` are cast after the read.
POST_FIELDS = ("Id", "PostTypeId", "ParentId", "Title", "Body", "Tags", "Score")
VOTE_FIELDS = ("PostId", "VoteTypeId")
COMMENT_FIELDS = ("PostId", "Score", "Text", "CreationDate")
BIGINT_FIELDS = ("Id", "ParentId", "PostId", "Score")

CURATED_PAIRS = _struct(
    ParentId=_L, Id=_L, Body=_S, Score=_L, Upvotes=_L, Downvotes=_L,
    QuestionLength=_L, AnswerLength=_L,
)
ENRICHED_PAIRS = _struct(
    question_id=_L, answer_id=_L, title=_S, question_body=_S,
    original_answer=_S, enriched_answer=_S, tags=_S,
)
TRACED_PAIRS = StructType(
    ENRICHED_PAIRS.fields
    + _struct(thinking_trace_re=_S, trace_truncated=_B).fields
)
RESPONSES = _struct(question_id=_L, content=_S, finish_reason=_S, error=_S)

MATH_ITEMS = _struct(question=_S, answer=_S)
CHOICE_ITEMS = _struct(question=_S, choices=ArrayType(_S), answer=IntegerType())
OPEN_ITEMS = _struct(question_id=_L, question_body=_S, enriched_answer=_S)

EVAL_RESULTS = _struct(
    benchmark=_S, model=_S, item_pos=_L, question=_S, reference_answer=_S,
    predicted_answer=_S, is_correct=_B, thinking_tokens=_L, answer_tokens=_L,
    time_seconds=_D, raw_output=_S,
)
JUDGE_RESPONSES = _struct(item_pos=_L, explanation=_S, finish_reason=_S, error=_S)
VERDICTS = _struct(
    item_pos=_L, question=_S, model_a=_S, model_b=_S, answer_a=_S, answer_b=_S,
    ft_won=_B, base_won=_B, tie=_B, judge_explanation=_S,
)
