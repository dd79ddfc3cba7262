"""Text expressions: strip, visible length, HTML cleaning, token counts, draws."""

import html
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

# The characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex class.
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"

# What is deleted or kept of an HTML body.
TAG = r"<[^>]+>"
CODE_START = "<pre><code>"
CODE_BLOCK = r"(?s)<pre><code>(.*?)</code></pre>"
# Stand around a code block while blanks next to them are stripped, each run once.
OPEN, CLOSE = "\ufdd0", "\ufdd1"
# Characters between tokens of the default count.
TOKEN_GAP = "\t\n\x0b\x0c\r "
TOKEN_AND_GAP = rf"[^{TOKEN_GAP}]++[{TOKEN_GAP}]*+"


def strip(col) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def text_or_empty(col) -> Column:
    return F.coalesce(col, F.lit(""))


def html_text_length(col) -> Column:
    """Characters left after deleting tags and outer whitespace; null counts 0."""
    visible = F.regexp_replace(text_or_empty(col), TAG, "")
    return F.length(strip(visible)).cast("bigint")


def _entity_decoder():
    # A local function travels to the workers by value: they need not have
    # this package on their path.
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return F.pandas_udf(decode, StringType())


_decode_entities = _entity_decoder()


def unescape_html(col) -> Column:
    """Decode HTML5 entities.

    Only texts with an ampersand travel to Python; the others go as nulls and
    keep their JVM value.
    """
    encoded = F.when(F.contains(col, F.lit("&")), col)
    return F.coalesce(_decode_entities(encoded), col)


def _mark_code(text: Column) -> Column:
    """Code blocks between marks, without blanks at their ends.

    The noncharacters U+FDD0 and U+FDD1 of such a text are deleted.
    """
    text = F.translate(text, OPEN + CLOSE, "")
    text = F.regexp_replace(text, CODE_BLOCK, f"\n[CODE]\n{OPEN}$1{CLOSE}\n[/CODE]\n")
    text = F.regexp_replace(text, rf"(?<!{WS}){WS}*{CLOSE}", CLOSE)
    text = F.regexp_replace(text, rf"{OPEN}{WS}*", OPEN)
    return F.translate(text, OPEN + CLOSE, "")


def clean_html(col) -> Column:
    """Readable text of an HTML body; null becomes the empty string.

    Entities are decoded first, so an encoded `&lt;b&gt;` is removed as a tag.
    Only a bare `<pre><code>` pair is kept as a marked code block; texts without one skip
    the search for it.
    """
    text = unescape_html(text_or_empty(col))
    text = F.when(F.contains(text, F.lit(CODE_START)), _mark_code(text)).otherwise(text)
    text = F.regexp_replace(text, TAG, "")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return strip(text)


def token_count(col, counter=None) -> Column:
    """Tokens of a text, 0 for null or empty.

    `counter` maps a column to a count column (for example a pandas UDF around
    a tokenizer); the default counts runs of non-space characters. It turns each
    run into one character and takes the length, which makes no array of tokens.
    """
    if counter is None:
        marks = F.regexp_replace(F.ltrim(col, F.lit(TOKEN_GAP)), TOKEN_AND_GAP, "x")
        counted = F.length(marks)
    else:
        counted = counter(col)
    return F.coalesce(counted.cast("bigint"), F.lit(0).cast("bigint"))


def tokenizer_counter(load):
    """A counter for `token_count` around a Python tokenizer.

    `load()` returns a function from text to number of tokens. It is called once
    per task, on the worker; texts arrive in Arrow batches.
    """
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = load()
        for texts in batches:
            yield texts.map(lambda text: tokens(text) if text else 0)

    return F.pandas_udf(count, LongType())


def draw_hash(key, seed, purpose) -> Column:
    """Hex digest of (purpose, seed, key): the same row gives the same draw."""
    name = F.coalesce(key.cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{purpose}:{seed}:"), name).cast("binary"))


def draw(key, seed, purpose) -> Column:
    """Uniform number in [0, 1) that depends on nothing but its arguments."""
    head = F.substring(draw_hash(key, seed, purpose), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(2**32))
