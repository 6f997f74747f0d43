"""Text predicates and text-to-value parsers, all built-in JVM expressions.

The functions take SQL text for the value, usually a quoted column name, and are written in SQL:
one call assembles what would be dozens of column objects.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as white space, as a pattern class.
_SPACES = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE, NOT_BLANK = f"[{_SPACES}]", f"[^{_SPACES}]"
# The same characters one by one.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if re.match(SPACE, c))

# The word pairs that make a column boolean, and what each word means.
BOOLEAN_PAIRS = [("t", "f"), ("true", "false"), ("yes", "no"), ("y", "n"), ("0", "1")]
TRUE_WORDS = ["t", "true", "yes", "y", "1"]
FALSE_WORDS = ["f", "false", "no", "n", "0"]

# Symbols removed from money text.
CURRENCY_SYMBOLS = "[$€£¥₹,]"

# The number grammar, and the spellings of infinity.
NUMBER = r"^[ \t\n\x0b\f\r]*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[ \t\n\x0b\f\r]*$"
WHOLE = r"^[ \t\n\x0b\f\r]*[+-]?\d+(\.0*)?[ \t\n\x0b\f\r]*$"
PLUS_INFINITY = ["inf", "+inf", "infinity", "+infinity"]
MINUS_INFINITY = ["-inf", "-infinity"]

# Names in dates, words that may stand in them, and the years accepted, those that a 64-bit
# count of nanoseconds holds in full.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
SHORT_WEEKDAYS = ["tues", "wednes", "thur", "thurs", "satur"]
FILLERS = ["at", "on", "and", "ad", "of", "m", "t"]
ORDINALS = ["st", "nd", "rd", "th"]
FIRST_YEAR, LAST_YEAR = 1678, 2261
#: Two-digit years up to this one are in this century, as C libraries have it.
LAST_NEW_YEAR = 68

_MONTH_WORDS = [m[:3] for m in MONTHS] + ["sept"] + MONTHS
_WORDS = [*_MONTH_WORDS, *[d[:3] for d in WEEKDAYS], *SHORT_WEEKDAYS, *WEEKDAYS, *FILLERS]
_YEAR = r"(?:167[89]|16[89][0-9]|1[7-9][0-9]{2}|2[01][0-9]{2}|22[0-5][0-9]|226[01])"

# The two most common shapes, which need no tokens: year first with an ISO clock, and numbers of which
# the last is a year, the first of them the month unless it exceeds 12.
_ISO = rf"^{_YEAR}-[0-9]{{1,2}}-[0-9]{{1,2}}(?:[T ][0-9]{{2}}:[0-9]{{2}}(?::[0-9]{{2}}(?:\.[0-9]{{1,6}})?(?:Z|[+-][0-9]{{2}}:[0-9]{{2}})?)?)?$"
_US_DAY = rf"^(0?[1-9]|1[0-2])([-/.])([0-9]{{1,2}})\2({_YEAR})$"
_DAY_FIRST = rf"^(1[3-9]|2[0-9]|3[01])([-/.])([0-9]{{1,2}})\2({_YEAR})$"

# A clock: numbers with colons, or with h, m and s, or an hour of half a day; then a zone. Names of zones
# other than universal time say nothing, and turn the sign of a number behind them.
_HALF = r"(?i:(a|p)(?:\.?m\.?)?(?![a-z]))"
_NO_DATE_WORD = "(?!(?i:" + "|".join(sorted({w[:3] for w in _WORDS if len(w) > 2})) + ")(?![A-Z]{2}))"
_ZONE = rf"(?: ?((?:{_NO_DATE_WORD}[A-Z]{{3,5}}|[Zz])(?![A-Za-z])))?(?: ?([+-][0-9]{{1,2}}(?::?[0-9]{{2}})?)(?![0-9:]))?"
_COLONS = rf"(?<![0-9:.])([0-9]{{1,2}}):([0-9]{{1,2}})(?::([0-9]{{1,2}})(?:\.([0-9]{{1,9}})|,[0-9]+)?)?(?![0-9:])(?: ?{_HALF})?{_ZONE}"
_LETTERS = (
    r"(?<![0-9:.])([0-9]{1,2}) ?(?i:h(?:r|ours?)?)(?:([0-9]{1,2})(?i: ?m(?:in(?:utes?)?)?)?| ([0-9]{1,2}) ?(?i:m(?:in(?:utes?)?)?))?"
    r"(?: ?([0-9]{1,2})(?: (?=[A-Za-z]+ ))?(?i:s(?:ec(?:onds?)?)?))?(?![A-Za-z0-9])"
)
_HOUR = rf"(?<![0-9:.])([0-9]{{1,2}}) ?(?i:(a|p)\.?m\.?(?![a-z])){_ZONE}"
_CLOCK = f"{_COLONS}|{_LETTERS}|{_HOUR}"
_CLOCK_PARTS = "|$1$8$12|$2$9$10|$3$11|$4|$5$13|$6$14|$7$15|"
_HOURS_BEHIND_DATE = [
    (r"^([0-9]{8})[T ]?([0-9]{2})([0-9]{2})([0-9]{2})$", "$1 $2:$3:$4"),
    (r"^([0-9]{8})[T ]?([0-9]{2})([0-9]{2})$", "$1 $2:$3"),
    (r"^([0-9]{8}|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2})[T ]([0-9]{1,2})$", "$1 $2:00"),
]
# What may be left beside the clock: numbers of a day, month, year or all three, words of dates, marks.
_DATE_TOKENS = (
    r"^(?:[ ,./;\x27-]++|(?<![0-9])(?:[0-9]{8}|[0-9]{4}|[0-9]{1,2})(?![0-9])(?:(?:" + "|".join(ORDINALS) + r")(?![a-z]))?"
    r"|(?<![a-z])(?:" + "|".join(sorted(_WORDS, key=len, reverse=True)) + r")(?![a-z]))*+$"
)
_QUARTER = rf"^(?:({_YEAR})-?[Qq]([1-4])|([1-4])[Qq]-?({_YEAR}))$"


def _list(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def strip_sql(v: str) -> str:
    return f"trim(BOTH '{WHITESPACE}' FROM {v})"


def number_sql(v: str) -> str:
    """SQL text of ``to_number``; only text that can overflow pays for the overflow test."""
    parsed = f"try_cast({v} AS DOUBLE)"
    bounded = f"nullif(nullif({parsed}, double('Infinity')), double('-Infinity'))"
    return (
        f"CASE WHEN {v} RLIKE r'{NUMBER}' THEN"
        f" CASE WHEN octet_length({v}) < 300 AND NOT {v} RLIKE '[eE]' THEN {parsed} ELSE {bounded} END"
        f" WHEN octet_length({v}) <= 9 AND lower({v}) IN {_list(PLUS_INFINITY)} THEN double('Infinity')"
        f" WHEN octet_length({v}) <= 9 AND lower({v}) IN {_list(MINUS_INFINITY)} THEN double('-Infinity') END"
    )


def _let(name: str, value: str, body: str) -> str:
    """SQL text of a body that uses a value several times; the value is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _clock_sql(y: str) -> str:
    """SQL text of seconds since midnight UTC, as a decimal, from the parts of a clock; null if there is none
    such on any day."""
    hour, minute, second, fraction, half, name, offset = (f"{y}[{i}]" for i in range(1, 8))
    number = f"cast({hour} AS INT)"
    hours = (
        f"CASE WHEN {half} = '' THEN IF({number} < 24, {number}, NULL)"
        f" WHEN {number} <= 12 THEN {number} % 12 + IF(lower({half}) = 'p', 12, 0) END"
    )
    sixty = [f"IF({v} = '', 0, IF(cast({v} AS INT) < 60, cast({v} AS INT), NULL))" for v in (minute, second)]
    part = f"cast(concat('0.', left(concat({fraction}, '0'), 6)) AS DECIMAL(8, 6))"
    digits = f"replace(substring({offset}, 2), ':', '')"
    away = (
        f"CASE WHEN length({digits}) <= 2 THEN cast({digits} AS INT) * 3600"
        f" ELSE cast(left({digits}, length({digits}) - 2) AS INT) * 3600 + cast(right({digits}, 2) AS INT) * 60 END"
    )
    east = f"IF((left({offset}, 1) = '+') = ({name} = ''), 1, -1)"
    shift = f"IF({offset} = '', 0, {east} * ({away}))"
    return f"(({hours}) * 3600 + {sixty[0]} * 60 + {sixty[1]} + {part} - {shift})"


def _roles_sql(p: str) -> str:
    """SQL text of the day that numbers and a month name stand for, from structs (v, n): the value, and the number
    of digits, 0 for a month name. Greater numbers are years; of small ones the month comes before the day."""

    def day(y: int, m: int | None, d: int | None) -> str:
        at = [f"{p}[{y}].v", f"{p}[{y}].n", "1" if m is None else f"{p}[{m}].v", "1" if d is None else f"{p}[{d}].v"]
        year = f"CASE WHEN {at[1]} = 4 THEN {at[0]} WHEN {at[0]} <= {LAST_NEW_YEAR} THEN 2000 + {at[0]} ELSE 1900 + {at[0]} END"
        return f"named_struct('y', {year}, 'm', {at[2]}, 'd', {at[3]})"

    def years(*places: int) -> list[str]:
        return [f"{p}[{i}].n = 4 OR ({p}[{i}].n > 0 AND {p}[{i}].v > 31)" for i in places]

    first, second = years(0, 1)
    return (
        f"CASE size({p})"
        f" WHEN 1 THEN CASE WHEN {p}[0].n = 4 THEN {day(0, None, None)} END"
        f" WHEN 2 THEN CASE WHEN {p}[0].n = 4 THEN {day(0, 1, None)} WHEN {p}[1].n = 4 THEN {day(1, 0, None)} END"
        f" WHEN 3 THEN CASE"
        f" WHEN {p}[0].n = 0 THEN IF({second}, {day(1, 0, 2)}, {day(2, 0, 1)})"
        f" WHEN {p}[1].n = 0 THEN IF({first}, {day(0, 1, 2)}, {day(2, 1, 0)})"
        f" WHEN {p}[2].n = 0 THEN IF({second}, {day(1, 2, 0)}, {day(0, 2, 1)})"
        f" WHEN {first} THEN {day(0, 1, 2)}"
        f" WHEN {p}[0].v > 12 THEN {day(2, 1, 0)} ELSE {day(2, 0, 1)} END END"
    )


def _tokens_sql(x: str) -> str:
    """SQL text for dates in any order of words, numbers and a clock, from text whose blanks are single spaces."""
    moved = x
    for shape, layout in _HOURS_BEHIND_DATE:
        moved = f"regexp_replace({moved}, r'{shape}', '{layout}')"
    cut = f"split(regexp_replace(IF({x} RLIKE '^[0-9]{{4}}', {moved}, {x}), r'{_CLOCK}', '{_CLOCK_PARTS}'), '[|]')"
    months = "array(" + ", ".join(f"'{m[:3]}'" for m in MONTHS) + ")"
    # a number that a comma follows without a space is taken for a decimal; its fraction says nothing
    rest = "regexp_replace(lower(IF(size(y) = 9, concat(y[0], ' ', y[8]), y[0])), r'([0-9]{2,}),[0-9]+', '$1')"
    whole = "regexp_replace(w, r'(?<![0-9])([0-9]{4})([0-9]{2})([0-9]{2})(?![0-9])', '$1 $2 $3')"
    part = (
        "CASE WHEN t RLIKE '^[0-9]' THEN named_struct('v', cast(t AS INT), 'n', length(t))"
        f" WHEN t IN {_list(_MONTH_WORDS)} THEN named_struct('v', cast(array_position({months}, left(t, 3)) AS INT), 'n', 0) END"
    )
    parts = f"filter(transform(regexp_extract_all({whole}, '[0-9]+|[a-z]+', 0), t -> {part}), t -> t IS NOT NULL)"
    one_name = "size(filter(p, t -> t.n = 0)) <= 1"
    valid = f"d.y BETWEEN {FIRST_YEAR} AND {LAST_YEAR} AND d.m <= 12 AND d.d <= 31"
    date = "try_cast(concat(d.y, '-', lpad(d.m, 2, '0'), '-', lpad(d.d, 2, '0')) AS TIMESTAMP)"
    seconds = f"IF(size(y) = 9, {_clock_sql('y')}, 0)"
    moment = f"CASE WHEN {valid} THEN {date} + make_dt_interval(0, 0, 0, {seconds}) END"
    judged = _let("p", parts, f"CASE WHEN {one_name} THEN " + _let("d", _roles_sql("p"), moment) + " END")
    likely = f"(size(y) = 1 OR size(y) = 9) AND w RLIKE r'{_DATE_TOKENS}' AND NOT w RLIKE '[0-9]{{4}}[a-z]'"
    return _let("y", cut, _let("w", rest, f"CASE WHEN {likely} THEN {judged} END"))


def datetime_sql(v: str) -> str:
    """SQL text of ``to_datetime``."""
    plain = f"regexp_replace({strip_sql(v)}, r'{SPACE}+', ' ')"
    quarter = "concat({0}, '-', {1} * 3 - 2, '-1')"
    year, number = (f"concat(regexp_extract(x, r'{_QUARTER}', {i}), regexp_extract(x, r'{_QUARTER}', {j}))" for i, j in ((1, 4), (2, 3)))
    # every date has a number, and nothing but letters, digits and a few marks
    likely = "x RLIKE r'^[A-Za-z0-9 ,./:;\\x27+-]*$' AND x RLIKE '[0-9].*[0-9]'"
    further = (
        f"CASE WHEN NOT ({likely}) THEN NULL"
        f" WHEN x RLIKE r'{_US_DAY}' THEN try_cast(regexp_replace(x, r'{_US_DAY}', '$4-$1-$3') AS TIMESTAMP)"
        f" WHEN x RLIKE r'{_DAY_FIRST}' THEN try_cast(regexp_replace(x, r'{_DAY_FIRST}', '$4-$3-$1') AS TIMESTAMP)"
        f" WHEN x RLIKE r'{_QUARTER}' THEN try_cast({quarter.format(year, f'cast({number} AS INT)')} AS TIMESTAMP)"
        f" ELSE {_tokens_sql('x')} END"
    )
    return f"CASE WHEN {v} RLIKE r'{_ISO}' THEN try_cast({v} AS TIMESTAMP) WHEN {v} IS NOT NULL THEN {_let('x', plain, further)} END"


def strip(v: str) -> Column:
    return F.expr(strip_sql(v))


def normalize_token(v: str) -> Column:
    return F.expr(strip_sql(f"lower({v})"))


def is_nil(v: str, data_type: T.DataType) -> Column:
    """The repair notion of missing: null, NaN, blank text, or the word ``nan`` in any case."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.expr(f"({v} IS NULL OR isnan({v}))")
    if isinstance(data_type, T.StringType):
        return F.expr(f"({v} IS NULL OR NOT {v} RLIKE r'{NOT_BLANK}' OR lower({v}) = 'nan')")
    return F.expr(f"({v} IS NULL)")


def is_missing(v: str, data_type: T.DataType) -> Column:
    """Null or floating NaN; text is never missing here."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.expr(f"({v} IS NULL OR isnan({v}))")
    return F.expr(f"({v} IS NULL)")


def to_number(v: str) -> Column:
    """Text to double; null for anything outside the number grammar, NaN and overflow."""
    return F.expr(number_sql(v))


def finite_sql(x: str) -> str:
    return f"(abs({x}) < double('Infinity'))"


def fits_integer_sql(x: str) -> str:
    """Whether a parsed number is finite, has no fraction and fits 64 bits."""
    return f"({finite_sql(x)} AND {x} = rint({x}) AND {x} >= -{2**63}D AND {x} < {2**63}D)"


def all_integers_sql(v: str) -> str:
    """SQL aggregate: whether every number of a text column fits an integer."""
    return f"coalesce(bool_and({fits_integer_sql('(' + number_sql(v) + ')')}), true)"


def to_integer(v: str) -> Column:
    """Text to bigint, exact beyond 2**53; text such as ``1e3`` goes through double. A number that is
    no integer is null, never cut."""
    plain = f"CASE WHEN {v} RLIKE r'{WHOLE}' THEN try_cast({v} AS BIGINT) END"
    number = f"({number_sql(v)})"
    return F.expr(f"coalesce({plain}, CASE WHEN {fits_integer_sql(number)} THEN try_cast({number} AS BIGINT) END)")


def to_boolean(v: str) -> Column:
    word = strip_sql(f"lower({v})")
    return F.expr(
        f"CASE WHEN {word} IN {_list(TRUE_WORDS)} THEN true WHEN {word} IN {_list(FALSE_WORDS)} THEN false END"
    )


def strip_currency_sql(v: str) -> str:
    return f"regexp_replace({v}, r'{CURRENCY_SYMBOLS}', '')"


def strip_currency(v: str) -> Column:
    return F.expr(strip_currency_sql(v))


def to_datetime(v: str) -> Column:
    """Text in mixed date formats to timestamp; clock-dependent forms are null.

    A value is parsed only in the shape it has, so a value that is no date costs a few pattern
    tests and no parse exception.
    """
    return F.expr(datetime_sql(v))


def iso_format(c: Column) -> Column:
    """Timestamp as ISO text, with microseconds only where there are any."""
    fraction = F.date_format(c, ".SSSSSS")
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))


def title_label(v: str) -> Column:
    """Axis label of a column name: underscores to spaces, each word capitalized."""
    return F.expr(f"initcap(replace({v}, '_', ' '))")


def path_stem(v: str) -> Column:
    """File name without its last extension."""
    return F.expr(f"regexp_replace(element_at(split({v}, '/'), -1), '(?<=.)[.][^.]*$', '')")


def path_parent(v: str) -> Column:
    """Name of the directory that holds the file; empty when there is none."""
    return F.expr(f"coalesce(try_element_at(split({v}, '/'), -2), '')")


def percent(part: Column, whole: Column, decimals: int) -> Column:
    """Share in percent, half-even rounded; 0 when the whole is 0."""
    return F.coalesce(F.bround(F.try_divide(part * F.lit(100.0), whole), decimals), F.lit(0.0))
