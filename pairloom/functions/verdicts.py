"""Judge verdicts: parsing and unblinding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions.text import WS

# Model names in stored verdicts.
TUNED, BASE = "Fine-Tuned", "Base"
TIE, ERROR = "Tie", "Error"

VERDICT = rf"(?i)Verdict:{WS}*(A|B|Tie)"


def verdict(col) -> Column:
    """First stated verdict as `A`, `B` or `TIE`; null when there is none."""
    found = F.upper(F.regexp_extract(col, VERDICT, 1))
    return F.when(F.length(found) > 0, found)


def other_model(model) -> Column:
    return F.when(model == TUNED, F.lit(BASE)).otherwise(F.lit(TUNED))


def unblind(stated, model_a) -> Column:
    """Winner behind a verdict: a model name, `Tie`, or `Error` for none."""
    return (
        F.when(stated == "TIE", F.lit(TIE))
        .when(stated == "A", model_a)
        .when(stated == "B", other_model(model_a))
        .otherwise(F.lit(ERROR))
    )
