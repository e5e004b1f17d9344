"""Text clean-up of chat replies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: a reasoning block (shortest match, over line breaks) and the white space
# that is trimmed around a reply ---
_THINK_BLOCK = r"(?s)<think>.*?</think>"
_WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_think(text: Column) -> Column:
    """Remove every reasoning block and the white space around what is left; NULL if nothing is."""
    kept = F.btrim(F.regexp_replace(text, _THINK_BLOCK, ""), F.lit(_WHITE_SPACE))
    return F.nullif(kept, F.lit(""))
