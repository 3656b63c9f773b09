"""Text functions: every one takes and returns a Column and stays in the JVM.

NULL text gives NULL. The white-space set is Unicode white space plus the four
ASCII separators, so that it is the same set Python's ``str.split`` uses.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters that count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Characters the normaliser turns into a space (as a class body).
SPECIAL_CLASS = r"""*"\n…+\-/=()'•:\[\]|!;"""

SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
WORD_RUN = r"(?U)[^\s\x1c-\x1f]+"


def strip(text: Column) -> Column:
    """Drop leading and trailing white space of every kind, not only blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def strip_special(text: Column) -> Column:
    """Each special character becomes one space."""
    return F.regexp_replace(text, f"[{SPECIAL_CLASS}]", " ")


def collapse_spaces(text: Column) -> Column:
    """Runs of blanks become one blank; tabs stay."""
    return F.regexp_replace(text, " +", " ")


def collapse_punct(text: Column, mark: str) -> Column:
    """Runs of one punctuation mark become a single mark."""
    if mark not in ("!", ",", "?"):
        raise ValueError(f"not a collapsible mark: {mark!r}")
    return F.regexp_replace(text, f"[{mark}]+", mark)


def normalize(text: Column, final_trim: bool = False) -> Column:
    """Strip, blank out special characters, collapse runs, lower-case.

    Two regular expressions do the work of five steps: blanking special
    characters and then collapsing blanks equals replacing each run of either
    by one blank, and the runs of "," and "?" collapse through one back
    reference ("!" is already a blank by then). ``final_trim`` drops the blank
    that a special character at either end leaves behind.
    """
    blanked = F.regexp_replace(strip(text), f"[{SPECIAL_CLASS} ]+", " ")
    lowered = F.lower(F.regexp_replace(blanked, r"([,?])\1+", "$1"))
    return strip(lowered) if final_trim else lowered


def words(text: Column) -> Column:
    """White-space separated words, without empty ones."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def word_count(text: Column) -> Column:
    """Number of white-space separated words, without building the array."""
    return F.regexp_count(text, F.lit(WORD_RUN))


# The replacements of the "13a" tokenisation, in order.
_TOK13A_LITERALS = (
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
)
# Two of the four patterns are written for speed, with the same words as result.
# The first class leaves out the blank it usually holds: that would only turn
# each blank into three, and the words are split at runs of blanks in the end.
# The second, ([^0-9])([\.,]) -> "$1 $2 ", takes marks in pairs; here the scan
# stops at marks only, and \G continues the pairs of a run of marks.
_TOK13A_PATTERNS = (
    (r"[\{-\~\[-\`!-\&\(-\+\:-\@\/]", " $0 "),
    (r"(?=[.,])(?:(?<=[^0-9.,])|(?:\G(?!^)|(?<=[0-9]))([.,]))([.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)


def tok13a(text: Column) -> Column:
    """Words after the "13a" rules, the tokenisation BLEU is defined on."""
    for old, new in _TOK13A_LITERALS:
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, new in _TOK13A_PATTERNS:
        text = F.regexp_replace(text, pattern, new)
    return words(text)
