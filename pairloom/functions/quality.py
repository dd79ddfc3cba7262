"""Predicates of the curation step."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what marks a body with an image.
IMAGE_MARK = "<img"


def vote_ok(min_upvotes=5, max_downvote_ratio=0.3) -> Column:
    """Enough upvotes, and downvotes within the ratio (both bounds inclusive)."""
    up, down = F.col("Upvotes"), F.col("Downvotes")
    return (up >= min_upvotes) & (down <= F.lit(float(max_downvote_ratio)) * up)


def has_image(col) -> Column:
    """The body holds the literal `<img`; a missing body has no image."""
    return F.coalesce(F.contains(col, F.lit(IMAGE_MARK)), F.lit(False))
