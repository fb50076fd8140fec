"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Greek and Cyrillic letters that look like Latin ones, and the Latin ones in the same order.
LOOKALIKES = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανАВЕКМНОРСТХаеорсухіѕј", "ABEZHIKMNOPTYXoavABEKMHOPCTXaeopcyxisj")


def fold_lookalikes(text: Column) -> Column:
    """Text with look-alike letters as Latin ones, odd spaces as plain ones and without invisible characters.

    Meant for matching Latin phrases only: it would damage text in Greek or Cyrillic. Null stays null.
    """
    invisible = "[\\u00ad\\u200b-\\u200f\\u2060\\ufeff]"
    spaces = "\\u00a0\\u2002\\u2003\\u2004\\u2005\\u2006\\u2007\\u2008\\u2009\\u200a\\u202f\\u3000"
    cleaned = F.regexp_replace(F.translate(text, *LOOKALIKES), invisible, "")
    return F.regexp_replace(cleaned, f"[{spaces}]", " ")
