"""Extraction and comparison of answers in model outputs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions.text import WS, strip

OPEN_QA = "ee_qa"
MULTIPLE_CHOICE = "mmlu_ee"
MATH = "gsm8k"

# Output formats the evaluated models are asked for.
THINK_OPEN, THINK_CLOSE = "<think>", "</think>"
REFERENCE_MARK = "#### "
BOXED = r"\\boxed\{([^}]*)\}"
BOXED_LETTER = r"(?i)\\boxed\{([A-D])\}"
LONE_LETTER = r"(?<![\p{L}\p{N}_])([A-Da-d])(?![\p{L}\p{N}_])"
ANCHOR = rf"(?:Final [Aa]nswer|The answer is|yields)[:{WS[1:]}*([0-9.,-]+)"
NUMBER = r"[-+]?\p{Nd}*\.?\p{Nd}+"
# Groups of three from the left, so `1000` is read as `100` and `0`.
LISTED_NUMBER = r"[-+]?\p{Nd}{1,3}(?:,\p{Nd}{3})*(?:\.\p{Nd}+)?|\p{Nd}+(?:\.\p{Nd}+)?"
# With strict=True an ungrouped run of digits is one number.
STRICT_NUMBER = (
    r"[-+]?(?:\p{Nd}{1,3}(?:,\p{Nd}{3})+(?!\p{Nd})|\p{Nd}+)(?:\.\p{Nd}+)?"
)


def _matches(col, pattern, group) -> Column:
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(group))


def _last(matches) -> Column:
    return F.try_element_at(matches, F.lit(-1))


def clean_number(col) -> Column:
    """First number of a text without thousands commas and closing dots.

    A text without a number is returned stripped; null or empty gives null.
    """
    text = F.replace(F.nullif(col, F.lit("")), F.lit(","), F.lit(""))
    text = F.regexp_replace(text, r"\.+\z", "")
    # Replaces the whole text by its first number, or leaves it as it is.
    return strip(F.regexp_replace(text, rf"(?s)\A.*?({NUMBER}).*\z", "$1"))


def stated_answer(col, strict=False) -> Column:
    """Raw numeric answer: last box, else first anchor phrase, else last number.

    A box that is present but empty does not fall through. Plain substring
    tests come before the expressions that few texts need.
    """
    box = F.when(F.contains(col, F.lit("\\boxed{")), _last(_matches(col, BOXED, 1)))
    phrase = F.contains(col, F.lit("nswer")) | F.contains(col, F.lit("yields"))
    anchor = F.when(phrase, F.get(_matches(col, ANCHOR, 1), F.lit(0)))
    number = _last(_matches(col, STRICT_NUMBER if strict else LISTED_NUMBER, 0))
    return F.coalesce(box, anchor, number)


def predicted_answer(col, strict=False) -> Column:
    """Numeric answer of a text; see `stated_answer` and `clean_number`.

    By default a run of four or more digits without commas is read in groups of
    three, so the last number of `1000` is `0`; `strict` reads it whole.
    """
    return clean_number(stated_answer(col, strict))


def mcq_answer(col) -> Column:
    """Letter A-D: last boxed letter, else last stand-alone letter, else null."""
    mark = F.contains(F.lower(col), F.lit("\\boxed{"))
    boxed = F.when(mark, _last(_matches(col, BOXED_LETTER, 1)))
    lone = _last(_matches(col, LONE_LETTER, 1))
    return F.upper(F.coalesce(boxed, lone))


def reference_answer(col) -> Column:
    """Number after the first `#### `; null when the marker is missing."""
    tail = strip(F.split_part(col, F.lit(REFERENCE_MARK), F.lit(2)))
    cleaned = F.coalesce(F.nullif(clean_number(tail), F.lit("")), tail)
    return F.when(F.contains(col, F.lit(REFERENCE_MARK)), cleaned)


def thinking_trace(col) -> Column:
    """First closed reasoning span, stripped; empty when there is none."""
    found = F.regexp_extract(col, rf"(?s){THINK_OPEN}(.*?){THINK_CLOSE}", 1)
    closed = F.contains(col, F.lit(THINK_CLOSE))
    return F.when(closed, strip(found)).when(~closed, F.lit(""))


def unclosed(col) -> Column:
    """The output opens a reasoning span and never closes any."""
    return F.contains(col, F.lit(THINK_OPEN)) & ~F.contains(col, F.lit(THINK_CLOSE))


def answer_part(col) -> Column:
    """Text after the last closing tag; empty for an unclosed span."""
    tail = strip(F.substring_index(col, THINK_CLOSE, -1))
    return F.when(unclosed(col), F.lit("")).otherwise(tail)


def exact_match(reference, predicted, benchmark, strict=False) -> Column:
    """Null-safe equality; null for open questions.

    Two nulls count as correct unless `strict`, which wants a prediction.
    """
    equal = reference.eqNullSafe(predicted)
    if strict:
        equal = equal & predicted.isNotNull()
    return F.when(~benchmark.eqNullSafe(F.lit(OPEN_QA)), equal)
