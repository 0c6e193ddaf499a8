"""URI decoding (F1) and lexical SQL-injection features.

Everything is a native column expression: no Python UDF touches a row.
Regexes run in the JVM (java.util.regex); the character classes that
differ between regex engines (Unicode digits and whitespace) are spelled
out explicitly, so the JVM and the DuckDB oracle agree with Python's
``str.isdigit`` / ``str.isspace`` semantics.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Detection patterns.  The alternation order of the keyword
# list matters (leftmost-first matching decides what is counted, e.g.
# ``information_schema`` counts in, or, schema and ``execute`` counts exec).
SQL_KEYWORDS = (
    "(select|union|drop|insert|update|delete|where|from|into|values|table|"
    "database|schema|concat|group_concat|load_file|outfile|benchmark|sleep|"
    "waitfor|case|when|having|order|by|limit|and|or|xor|not|null|like|in|"
    "between|exists|exec|execute|xp_cmdshell|information_schema)"
)
COMMENT_MARKS = ("--", "#", "/*", "*/")
OR_TRUE_TEMPLATE = r"('|\")?{ws}*(or|and){ws}+('?1'?{ws}*={ws}*'?1'?|'?true'?|'a'{ws}*={ws}*'a')"
QUOTE_MARKS = ("'", '"')
ENCODED_MARKS = ("%27", "%22", "%3d", "%3b", "%2d%2d", "%23")
SPECIAL_CHARS = "'\";=%()"
PARAM_CHARS = "&?"
MISSING_TEXT = "nan"  # how a missing payload prints before lower-casing
# ---------------------------------------------------------------------------


def _code_point_class(pred) -> str:
    """Regex character class of all code points satisfying ``pred``,
    as ``\\x{..}`` ranges (understood by Java and RE2 alike)."""
    ranges, start, prev = [], None, None
    for cp in range(sys.maxunicode + 1):
        if pred(chr(cp)):
            if start is None:
                start = cp
            elif cp != prev + 1:
                ranges.append((start, prev))
                start = cp
            prev = cp
    if start is not None:
        ranges.append((start, prev))
    parts = [f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges]
    return "[" + "".join(parts) + "]"


# Every code point Python's ``str.isdigit`` accepts (derived from the Unicode
# tables, ~800 characters): counted with ``translate`` (one hash lookup per
# character) instead of a regex character class.
DIGIT_CHARS = "".join(chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isdigit())
SPACE_CLASS = _code_point_class(str.isspace)
# Whether the pattern matches does not depend on its optional beginning, and
# without that a search only starts at "or" and "and".
OR_TRUE = OR_TRUE_TEMPLATE.format(ws=SPACE_CLASS)
OR_TRUE = OR_TRUE[OR_TRUE.index("(or|and)"):]

#: The lower-case characters besides a-z whose capitals are A-Z: after lower-casing
#: and this translation, matching needs no case flags.
FOLDED = ("\u017f\u0131", "si")


def _by_first_letter(alternation: str) -> str:
    """The words of an alternation grouped by their first letters.  Of the words
    that may match at a place all are in one group, in their old order, so the same
    one matches; the others fail at the group's letter, and most places already at
    the look-ahead for any of the letters."""
    groups: dict[str, list[str]] = {}
    for word in alternation.strip("()").split("|"):
        groups.setdefault(word[0], []).append(word[1:])
    branches = [f"{first}(?:{'|'.join(rest)})" for first, rest in groups.items()]
    return f"(?=[{''.join(sorted(groups))}])(?:{'|'.join(branches)})"


KEYWORD_SEARCH = _by_first_letter(SQL_KEYWORDS)


# ---------------------------------------------------------------------------
# double percent-decoding
def percent_decode(c: Column) -> Column:
    """One round of ``%XX`` decoding that keeps ``+`` and malformed escapes
    (bare ``%``) as they are; invalid UTF-8 becomes U+FFFD.

    ``url_decode`` would turn ``+`` into a space and fail on a bare ``%``,
    so both are escaped first.
    """
    protected = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")),
                                 r"%(?![0-9a-fA-F]{2})", "%25")
    return F.url_decode(protected)


def decode_uri(c: Column) -> Column:
    """decode twice (double encoding), then lower-case."""
    return F.lower(percent_decode(percent_decode(c)))


# ---------------------------------------------------------------------------
# F2-F13
def _count_chars(u: Column, chars: str) -> Column:
    # occurrences of any of ``chars``: length minus length without them
    return F.length(u) - F.length(F.translate(u, chars, ""))


def _has_any(u: Column, marks: tuple[str, ...]) -> Column:
    # plain substring searches; ``u`` is lower-cased, and so are the marks
    found = u.contains(marks[0])
    for m in marks[1:]:
        found = found | u.contains(m)
    return found


def lexical_feature_columns(uri: Column) -> dict[str, Column]:
    """The 11 lexical features of one payload column, in model order."""
    u = F.lower(F.coalesce(uri.cast("string"), F.lit(MISSING_TEXT)))
    kw_count = F.regexp_count(F.translate(u, *FOLDED), F.lit(KEYWORD_SEARCH))
    special = _count_chars(u, SPECIAL_CHARS)
    length = F.length(u)
    digits = _count_chars(u, DIGIT_CHARS)
    return {
        "has_sql_keywords": (kw_count > 0).cast("int"),
        "has_comment": _has_any(u, COMMENT_MARKS).cast("int"),
        "has_or_true": u.rlike(OR_TRUE).cast("int"),
        "has_quotes": _has_any(u, QUOTE_MARKS).cast("int"),
        "has_encoded_chars": _has_any(u, ENCODED_MARKS).cast("int"),
        "special_char_count": special.cast("bigint"),
        "keyword_count": kw_count.cast("bigint"),
        "payload_length": length.cast("bigint"),
        "param_count": _count_chars(u, PARAM_CHARS).cast("bigint"),
        "digit_ratio": digits / (length + 1),
        "special_ratio": special / (length + 1),
    }


def add_lexical_features(df: DataFrame, uri_column: str = "decoded_uri") -> DataFrame:
    """F2-F13 appended to ``df`` (the features are derived columns of the
    same row: no join, no shuffle)."""
    return df.withColumns(lexical_feature_columns(F.col(uri_column)))
