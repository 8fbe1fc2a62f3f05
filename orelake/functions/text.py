"""Text clean-up expressions with the exact semantics of the source rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as "true" for a contact flag.
TRUTHY_VALUES = ["1", "true", "yes", "y"]
# The characters Python's str.strip() removes (str.isspace()).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
              "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Strip all leading/trailing white space (not only blanks, unlike SQL trim)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


# Letters and symbols that have a case; any other character starts a new word.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}\p{IsUppercase}\p{IsLowercase}"


def title_case(col) -> Column:
    """Title-case the first of every run of cased characters, lower-case the rest.

    Word boundaries are all characters without case, so ``o'neil-smith 3rd``
    becomes ``O'Neil-Smith 3Rd`` (``initcap`` alone only splits on blanks).  A
    blank is put after every one of them, ``initcap`` applied, and exactly that
    blank removed again: three code-generated string functions, no lambda.
    """
    spaced = F.regexp_replace(_c(col), f"([^{_CASED}])", "$1 ")
    return F.regexp_replace(F.initcap(spaced), f"([^{_CASED}]) ", "$1")


def capitalize_first(col) -> Column:
    """First character title-cased, all others lower case."""
    c = _c(col)
    return F.concat(F.initcap(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 1 << 30)))


def digits_only(col) -> Column:
    """Keep the digits; an empty result becomes NULL."""
    return F.nullif(F.regexp_replace(_c(col).cast("string"), "[^0-9]", ""), F.lit(""))


def truthy(col) -> Column:
    """Boolean from loose text (``1/true/yes/y``, any case and padding); NULL is false."""
    text = F.lower(py_strip(_c(col).cast("string")))
    return F.coalesce(text.isin(*TRUTHY_VALUES), F.lit(False))
