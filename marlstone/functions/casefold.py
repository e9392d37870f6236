"""Text keys under NFKC and full case folding, which the built-in functions lack: Arrow batches, one pass a column."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


@pandas_udf(StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())


#: Unicode white space, as java.util.regex reads it.
BLANK = r"(?U)\s"
ENDS = " \t\r\n\"'`.,;:!?"
#: (pattern, replacement) in the order in which they apply to a prompt.
PROMPT_RULES = (
    ("[“”]", '"'),
    ("[‘’]", "'"),
    (rf"{BLANK}+", " "),
    (r"^ | $", ""),
    (r" ([,.;:!?])", "$1"),
    (r"([(\[{]) ", "$1"),
    (r" ([)\]}])", "$1"),
    (r" ?([+*/=]) ?", "$1"),
)


def folded(text: Column) -> Column:
    return _folded(text)


def folded_key(text: Column) -> Column:
    """NFKC, case folded, white space collapsed and trimmed; null stays null."""
    return F.regexp_replace(F.regexp_replace(folded(text), rf"{BLANK}+", " "), "^ | $", "")


def prompt_key(text: Column) -> Column:
    """folded_key with straight quotes, no blanks beside punctuation, brackets and + * / =, and no quotes or stops at the ends."""
    out = folded(text)
    for pattern, replacement in PROMPT_RULES:
        out = F.regexp_replace(out, pattern, replacement)
    return F.btrim(out, F.lit(ENDS))
