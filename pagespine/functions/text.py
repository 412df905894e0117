"""Text tests and measures as Column expressions.

``(?U)`` makes ``\\d`` and ``\\s`` follow Unicode, ``(?d)`` makes only
``\\n`` a line end. U+001C to U+001F count as white space, which Java leaves out.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagespine.constants import HEADING_KEYWORDS, KEYWORD_TRIM, PUNCTUATION_SHARE

# The patterns that decide what a text is.
SPACE = r"[\s\x1c-\x1f]"
NOT_SPACE = r"[^\s\x1c-\x1f]"
PAGE_NUMBER = rf"(?iuUd)^(page|pg\.?){SPACE}+\d+({SPACE}+of{SPACE}+\d+)?$"
DIGITS_AND_SYMBOLS = r"(?U)^[\d\s\x1c-\x1f.\-/:()]+\z"
WORD_EDGE_LEFT, WORD_EDGE_RIGHT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
MONTH_WORD = rf"(?iu)(?=[JFMASOND]){WORD_EDGE_LEFT}(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*{WORD_EDGE_RIGHT}"
NUMERIC_DATE = rf"(?U)(?=\d{{1,2}}[/-]){WORD_EDGE_LEFT}\d{{1,2}}[/-]\d{{1,2}}[/-]\d{{2,4}}{WORD_EDGE_RIGHT}"
DOTTED_LEADER = "..."
LAST_NUMBER = rf"(?Ud)\d{SPACE}*$"
CONTENTS_LINE = rf"(?iuUd)(section|chapter|\d+\.?\d*){SPACE}+.*\.{{3,}}.*\d+"
BRACKET_WORD = r"^\[[A-Za-z0-9_-]+\]"
BRACKET_NUMBER = r"(?U)^\[\d+\]"
BRACKET_AUTHOR_YEAR = r"(?Ud)^\[[A-Za-z]+.*\d{4}.*\]"
LEADING_NUMBER = rf"(?U)^(\d+(?:\.\d+){{0,2}}){SPACE}+"


def _space_characters() -> str:
    codes = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    return "".join(map(chr, codes))


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends, looking at the ends only."""
    return F.btrim(text, F.lit(_space_characters()))


def word_count(text: Column) -> Column:
    """Runs of non-space characters."""
    return F.regexp_count(text, F.lit(f"(?U){NOT_SPACE}+"))


def first_word(text: Column) -> Column:
    """Text up to the first blank, in lower case, without bullets and colons."""
    return F.btrim(F.lower(F.substring_index(text, " ", 1)), F.lit(KEYWORD_TRIM))


def starts_with_keyword(text: Column, keywords=HEADING_KEYWORDS) -> Column:
    return first_word(text).isin(*keywords)


def is_page_number(text: Column) -> Column:
    return text.rlike(PAGE_NUMBER)


def is_mostly_punctuation(text: Column, share: float = PUNCTUATION_SHARE) -> Column:
    marks = F.length(F.regexp_replace(text, r"\P{P}+", ""))
    return (F.length(text) > 5) & (marks / F.length(text) >= share)


def is_only_symbols_or_digits(text: Column) -> Column:
    return text.rlike(DIGITS_AND_SYMBOLS)


def is_date(text: Column) -> Column:
    """A word that begins like a month ("Market" is one), or a day/month/year number. Plain searches spare most texts the second pattern."""
    return text.rlike(MONTH_WORD) | ((text.contains("/") | text.contains("-")) & text.rlike(NUMERIC_DATE))


def is_contents_entry(text: Column) -> Column:
    """Dotted leader before a page number. The plain search spares most texts the patterns."""
    return text.contains(DOTTED_LEADER) & (text.rlike(LAST_NUMBER) | text.rlike(CONTENTS_LINE))


def is_citation(text: Column) -> Column:
    return (
        text.startswith("[")
        & text.contains("]")
        & (text.rlike(BRACKET_WORD) | text.rlike(BRACKET_NUMBER) | text.rlike(BRACKET_AUTHOR_YEAR))
    )


def is_valid_heading_start(text: Column) -> Column:
    """False only when the first letter is lower-case."""
    return ~F.regexp_extract(text, r"(\p{L})", 1).rlike(r"\p{IsLowercase}")


def numbering_level(text: Column) -> Column:
    """H1, H2 or H3 for texts that begin with 1, 1.2 or 1.2.3 and a space, else null."""
    number = F.regexp_extract(text, LEADING_NUMBER, 1)
    dots = F.length(number) - F.length(F.replace(number, F.lit("."), F.lit("")))
    return F.when(number != "", F.concat(F.lit("H"), (dots + 1).cast("string")))


def is_upper(text: Column) -> Column:
    return text.rlike(r"\p{IsUppercase}") & ~text.rlike(r"[\p{IsLowercase}\p{Lt}]")


def is_alnum(text: Column) -> Column:
    return text.rlike(r"^[\p{L}\p{N}]+\z")


def never_heading(text: Column) -> Column:
    """The tests that send a block to the body, whatever its label."""
    return (
        is_only_symbols_or_digits(text)
        | is_citation(text)
        | is_contents_entry(text)
        | is_page_number(text)
        | is_mostly_punctuation(text)
        | is_date(text)
    )
