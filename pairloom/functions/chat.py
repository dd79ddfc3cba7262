"""Chat records: question and assistant texts, message arrays, serialization."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions.text import strip, text_or_empty, token_count

# ChatML markers.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def question_text(title, body) -> Column:
    return strip(F.concat(text_or_empty(title), F.lit("\n\n"), text_or_empty(body)))


def assistant_text(answer, trace, keep_trace=None) -> Column:
    """Answer without bold marks, after its reasoning span when there is one.

    Where `keep_trace` is false the span stays, emptied.
    """
    plain = F.replace(text_or_empty(answer), F.lit("**"), F.lit(""))
    trace = text_or_empty(trace)
    shown = trace if keep_trace is None else F.when(keep_trace, trace).otherwise(F.lit(""))
    spanned = F.concat(F.lit("<think>"), shown, F.lit("</think>\n\n"), plain)
    return F.when(F.length(trace) > 0, spanned).otherwise(plain)


def message(role, content) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(system_prompt, question, answer) -> Column:
    return F.array(
        message("system", F.lit(system_prompt)),
        message("user", question),
        message(ASSISTANT, answer),
    )


def turn_text(role, content) -> Column:
    """One turn with its markers; this is the model-specific template."""
    return F.concat(
        F.lit(TURN_START), text_or_empty(role), F.lit("\n"),
        text_or_empty(content), F.lit(TURN_END + "\n"),
    )


def chat_serialize(msgs, turn=turn_text) -> Column:
    """All turns of a message array in one text."""
    return F.array_join(F.transform(msgs, lambda m: turn(m["role"], m["content"])), "")


def supervised_tokens(msgs) -> Column:
    """Tokens that count for the loss: those of assistant turns."""
    return _tokens(F.filter(msgs, lambda m: is_assistant(m["role"])))


def masked_tokens(msgs) -> Column:
    """Tokens of all other turns, hidden from the loss."""
    return _tokens(F.filter(msgs, lambda m: ~is_assistant(m["role"])))


def is_assistant(role) -> Column:
    return role.eqNullSafe(F.lit(ASSISTANT))


def _tokens(msgs) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.aggregate(msgs, zero, lambda total, m: total + token_count(m["content"]))
