"""Record encoding and decoding: JSON, CSV text, header bytes, timestamp text.

All of it is built-in Spark expressions (``to_json``/``from_json``, ``date_format``,
``concat_ws``...), so encoding and decoding run inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference): the click JSON timestamp pattern uses the 12-hour
# clock ``hh`` without an AM/PM marker, so 13:00 prints as 01:00.
CLICK_TS_PATTERN = "dd-MM-yyyy hh:mm:ss:SSS"
# The 6 click pages in generator rotation order.
CLICK_PAGES = ["/help", "/index", "/shop", "/jobs", "/about", "/news"]
# Replay timestamps are shifted to this zone and printed without it.
REPLAY_ZONE = "Asia/Shanghai"
MISSING_HEADER = "<missing>"
# JSON text keeps event time to the microsecond (Spark's default JSON format stops at ms).
JSON_TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                   "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

CLICK_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("page", T.StringType()),
])


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def click_ts_text(ts) -> Column:
    """Timestamp -> ``dd-MM-yyyy hh:mm:ss:SSS`` text (12-hour clock, no marker)."""
    return F.date_format(_c(ts), CLICK_TS_PATTERN)


def parse_click_ts(text) -> Column:
    """``dd-MM-yyyy hh:mm:ss:SSS`` text -> TIMESTAMP_NTZ; hours 01..12 are read as AM."""
    return F.to_timestamp_ntz(_c(text), F.lit(CLICK_TS_PATTERN))


def encode_json(*cols: Column) -> Column:
    """One JSON object per row (key order = column order)."""
    return F.to_json(F.struct(*cols))


def decode_json(value, schema: T.StructType, failfast: bool = False) -> Column:
    """Parse JSON text into a struct. ``failfast`` raises on a malformed record (the typed
    deserializer behaviour); otherwise malformed records become null fields."""
    opts = {"mode": "FAILFAST"} if failfast else {"mode": "PERMISSIVE"}
    return F.from_json(_c(value), schema, opts)


def quoted_number(value, target: str = "bigint") -> Column:
    """A JSON number written as a string (``"23"``) read as a number: ``try_cast`` of the text
    (``from_json`` with a numeric schema gives NULL for a quoted number)."""
    return _c(value).try_cast(target)


def header_text(headers, name: str) -> Column:
    """Text of the last header called ``name`` in an ``array<struct<key,value:binary>>``:
    ``<missing>`` when absent or null, the text when every byte is printable ASCII (32..126),
    otherwise ``0x`` plus lower-case hex of the bytes."""
    last = F.try_element_at(F.filter(_c(headers), lambda h: h["key"] == F.lit(name)), F.lit(-1))
    raw = last["value"]
    hexed = F.hex(raw)
    # every byte in 0x20..0x7E <=> the UTF-8 text is printable ASCII; decode only then, so
    # invalid UTF-8 never reaches the decoder
    printable = hexed.rlike("^([2-6][0-9A-F]|7[0-9A-E])*$")
    return (F.when(last.isNull() | raw.isNull(), F.lit(MISSING_HEADER))
             .when(printable, F.decode(raw, "UTF-8"))
             .otherwise(F.concat(F.lit("0x"), F.lower(hexed))))


def instant_text(ts) -> Column:
    """ISO-8601 UTC text of a timestamp, fraction printed in groups of 3 digits only when
    non-zero (``2020-01-01T12:00:00Z``, ``...:07.179575Z`` -> ``...:07.179575Z``)."""
    c = _c(ts)
    micros = F.pmod(F.unix_micros(c.cast("timestamp")), F.lit(1_000_000))
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = (F.when(micros == 0, F.lit(""))
             .when(micros % 1000 == 0, F.format_string(".%03d", (micros / 1000).cast("int")))
             .otherwise(F.format_string(".%06d", micros.cast("int"))))
    return F.concat(base, frac, F.lit("Z"))


def replay_ts_text(epoch_ms, zone: str = REPLAY_ZONE) -> Column:
    """Epoch milliseconds -> wall-clock text in ``zone`` without the zone
    (``yyyy-MM-dd HH:mm:ss`` plus a fraction only when it is non-zero)."""
    ms = _c(epoch_ms)
    local = F.from_utc_timestamp(F.timestamp_millis(ms), zone)
    frac = F.pmod(ms, F.lit(1000))
    return F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"),
                    F.when(frac == 0, F.lit("")).otherwise(
                        F.regexp_replace(F.format_string(".%03d", frac.cast("int")), "0+$", "")))


def csv_line(*cols: Column) -> Column:
    """Comma-joined text of the columns (nulls print as empty)."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def split_csv(df: DataFrame, line: str, names: list[str], types: list[str]) -> DataFrame:
    """Split a text column on commas into typed columns; lines with fewer fields are dropped."""
    parts = F.split(F.col(line), ",")
    out = df.where(F.size(parts) >= len(names))
    return out.select(*[parts[i].try_cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))])


def flag_text(is_start) -> Column:
    return F.when(_c(is_start), F.lit("START")).otherwise(F.lit("END"))
