"""SQL functions that transform text written for an embedded SQL engine expects.

They are temporary SQL functions of the session, so the optimizer inlines them into the
calling plan. A time is text, a date or a timestamp; a bare number is a Julian day, or
seconds with the modifier `unixepoch`; `now` is the time of the query; text that is no
time gives null instead of an error. Up to four modifiers follow a time:
`+1 month`, `-7 days`, `start of month`, `weekday 1` and the like; an unknown one gives null.

What a SQL function cannot express stays with Spark's own names: `iif` (its type follows its
arguments: `if`), two-argument `max` / `min` (`greatest` / `least`), `group_concat` and `total`
(aggregates: `listagg`, `coalesce(sum(x), 0)`), `date` and `time` with modifiers (built-in
names: `day_of`, `time_of`), the operator `GLOB` (the function `glob`), `/` between whole numbers (`div`) and
the case rule of `LIKE` (`ILIKE`).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# --- fixed values: format directive -> SQL over the time `at` ---
DIRECTIVES = {
    "%Y": "date_format(at, 'yyyy')", "%m": "date_format(at, 'MM')", "%d": "date_format(at, 'dd')",
    "%H": "date_format(at, 'HH')", "%M": "date_format(at, 'mm')", "%S": "date_format(at, 'ss')",
    "%f": "date_format(at, 'ss.SSS')", "%j": "date_format(at, 'DDD')",
    "%s": "CAST(unix_seconds(at) AS STRING)", "%w": "CAST(dayofweek(at) - 1 AS STRING)",
    "%W": "lpad(CAST((dayofyear(at) + 6 - weekday(at)) DIV 7 AS STRING), 2, '0')",
}
# Julian day number of 1970-01-01 00:00 UTC.
UNIX_EPOCH_JULIAN = 2440587.5
# Date of a time without one.
TIME_ONLY_DATE = "2000-01-01"
# --- end of fixed values ---

_DAY = "86400000000D"
_MODIFIERS = [f"m{i}" for i in range(1, 5)]
_MORE = ", ".join(f"{m} STRING DEFAULT NULL" for m in _MODIFIERS)
_PASSED = ", ".join(_MODIFIERS)

_START = f"""CASE
  WHEN lower(m1) = 'unixepoch' THEN timestamp_micros(CAST(TRY_CAST(t AS DOUBLE) * 1000000 AS BIGINT))
  WHEN lower(t) = 'now' THEN current_timestamp()
  WHEN t RLIKE '^[0-9]+([.][0-9]*)?$' THEN timestamp_micros(CAST(round((TRY_CAST(t AS DOUBLE) - {UNIX_EPOCH_JULIAN}D) * {_DAY}) AS BIGINT))
  WHEN t RLIKE '^[0-9]{{1,2}}:[0-9]{{2}}' THEN TRY_CAST('{TIME_ONLY_DATE} ' || t AS TIMESTAMP)
  ELSE TRY_CAST(t AS TIMESTAMP) END"""

# Months run over into the next one as days do: January 31 and one month is the third of March (or the second).
_ADD_MONTHS = """timestampadd(MICROSECOND, timestampdiff(MICROSECOND, date_trunc('month', at), at),
  timestampadd(MONTH, CAST({n} AS INT), date_trunc('month', at)))"""
_N = "TRY_CAST(regexp_extract(m, '^([+-]?[0-9.]+) ', 1) AS DOUBLE)"
_UNIT = "regexp_extract(lower(m), '^[+-]?[0-9.]+ +(second|minute|hour|day|month|year)s?$', 1)"


def _add(micros: str) -> str:
    return f"timestamp_micros(unix_micros(at) + CAST(round({_N} * {micros}) AS BIGINT))"


_MOVED = f"""CASE
  WHEN m IS NULL OR lower(m) IN ('unixepoch', 'utc', 'localtime') THEN at
  WHEN lower(m) IN ('start of day', 'start of month', 'start of year') THEN date_trunc(substr(lower(m), 10), at)
  WHEN m RLIKE '^(?i)weekday [0-6]$' THEN timestampadd(DAY, pmod(CAST(substr(m, 9) AS INT) - dayofweek(at) + 1, 7), at)
  WHEN {_UNIT} = 'month' THEN {_ADD_MONTHS.format(n=_N)}
  WHEN {_UNIT} = 'year' THEN {_ADD_MONTHS.format(n=f'12 * {_N}')}
  WHEN {_UNIT} = 'day' THEN {_add(_DAY)}
  WHEN {_UNIT} = 'hour' THEN {_add('3600000000D')}
  WHEN {_UNIT} = 'minute' THEN {_add('60000000D')}
  WHEN {_UNIT} = 'second' THEN {_add('1000000D')} END"""

# A pattern is cut into character classes and single characters; each becomes a piece of a regular expression.
_GLOB = r"""concat(r'(?s)\A', array_join(transform(regexp_extract_all(pattern, r'(\[\^?\]?[^\]]*\]|.|\n)', 1), p -> CASE
  WHEN p = '*' THEN '.*' WHEN p = '?' THEN '.'
  WHEN length(p) > 1 THEN concat(substr(p, 1, 1), regexp_replace(substr(p, 2, length(p) - 2), r'([\\\[&]|(?<=^|\^)\])', r'\\$1'), ']')
  WHEN p RLIKE r'[.+(){}|^$\\\[\]]' THEN concat(r'\', p) ELSE p END), ''), r'\z')"""


def _label() -> str:
    """`%%` steps aside first; a time that is null makes the label null."""
    label = "replace(fmt, '%%', '\\0')"
    for directive, text in DIRECTIVES.items():
        label = f"replace({label}, '{directive}', {text})"
    return f"CASE WHEN at IS NOT NULL THEN replace({label}, '\\0', '%') END"


def _functions() -> dict[str, str]:
    time = f"sqlname_time(t, {_PASSED})"
    # A fold keeps the plan of one modifier, however many follow.
    moved = f"""CASE WHEN coalesce({_PASSED}) IS NULL THEN sqlname_start(t, m1)
      ELSE aggregate(array({_PASSED}), sqlname_start(t, m1), (at, m) -> {_MOVED}) END"""
    return {
        "sqlname_start(t STRING, m1 STRING) RETURNS TIMESTAMP": _START,
        f"sqlname_time(t STRING, {_MORE}) RETURNS TIMESTAMP": moved,
        "sqlname_label(fmt STRING, at TIMESTAMP) RETURNS STRING": _label(),
        f"strftime(fmt STRING, t STRING, {_MORE}) RETURNS STRING": f"sqlname_label(fmt, {time})",
        f"datetime(t STRING, {_MORE}) RETURNS STRING": f"date_format({time}, 'yyyy-MM-dd HH:mm:ss')",
        f"time_of(t STRING, {_MORE}) RETURNS STRING": f"date_format({time}, 'HH:mm:ss')",
        f"day_of(t STRING, {_MORE}) RETURNS DATE": f"CAST({time} AS DATE)",
        f"unixepoch(t STRING, {_MORE}) RETURNS BIGINT": f"unix_seconds({time})",
        f"julianday(t STRING, {_MORE}) RETURNS DOUBLE": f"unix_micros({time}) / {_DAY} + {UNIX_EPOCH_JULIAN}D",
        "glob(pattern STRING, text STRING) RETURNS BOOLEAN": f"text RLIKE {_GLOB}",
        "json_extract(doc STRING, path STRING) RETURNS STRING": "get_json_object(doc, path)",
    }


def register(spark: SparkSession) -> None:
    """Once per session."""
    if spark.catalog.functionExists("sqlname_start"):
        return
    for head, body in _functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
