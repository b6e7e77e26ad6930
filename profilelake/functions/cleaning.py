"""Cleaning of raw instrument values."""

from profilelake.schema import BGC_PARAMS, CORE_PARAMS

# Fill markers of the raw files, and the day count's origin.
FILL_VALUES = [99999.0, -999.0]
FILL_ABOVE = 1e35
EPOCH = "1950-01-01"

# days from the epoch to 0001-01-01 and to 9999-12-31
_FIRST_DAY, _LAST_DAY = -711857, 2940201
# every character the stripping of text removes: blanks of ASCII and Unicode, and NUL
_STRIPPED_ASCII = (
    "\\u0020\\u0000\\u0009\\u000a\\u000b\\u000c\\u000d\\u001c\\u001d\\u001e\\u001f"
)
_STRIPPED = _STRIPPED_ASCII + (
    "\\u0085\\u00a0\\u1680\\u2000\\u2001\\u2002\\u2003\\u2004\\u2005"
    "\\u2006\\u2007\\u2008\\u2009\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
)


def sql_list(values: list) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}D" for v in values)


def clean_text(x: str) -> str:
    """Text without NULs and outer blanks; empty becomes null."""
    return rf"nullif(replace(trim(both '{_STRIPPED}' from {x}), '\u0000', ''), '')"


def stripped_cell(x: str) -> str:
    """Text without NULs and outer blanks, for use inside a lambda.

    A text of one-byte characters is stripped of the ASCII blanks only, since every character
    of a text's ends costs a search in the list.
    """
    stripped = (
        f"if(octet_length({x}) = char_length({x}), trim(both '{_STRIPPED_ASCII}' from {x}), "
        f"trim(both '{_STRIPPED}' from {x}))"
    )
    return rf"replace({stripped}, '\u0000', '')"


def clean_cell(x: str) -> str:
    """``clean_text`` for use inside a lambda, where ``nullif`` would evaluate its argument twice."""
    return f"get(array_remove(array({stripped_cell(x)}), ''), 0)"


def clean_chars(x: str) -> str:
    """``clean_text`` of an array of single characters."""
    return clean_text(f"array_join({x}, '')")


def clean_bytes(x: str) -> str:
    """``clean_text`` of raw bytes; malformed UTF-8 becomes the replacement character."""
    return clean_text(f"make_valid_utf8(cast({x} as string))")


def clean_text_array(x: str) -> str:
    """``clean_text`` of each element. Lambdas are not compiled, so an element is stripped once
    and made null in a second pass; ``nullif`` would strip it twice."""
    return f"transform(transform({x}, t -> {stripped_cell('t')}), s -> if(s = '', null, s))"


def clean_numeric(x: str) -> str:
    """Double, null for NaN, infinities and fill markers (NaN sorts above all numbers)."""
    # a list test is the dearest part inside a lambda, which is not compiled
    filled = " and ".join(f"{x} <> {v!r}D" for v in FILL_VALUES)
    return f"case when abs({x}) <= {FILL_ABOVE!r}D and {filled} then cast({x} as double) end"


def clean_int(x: str) -> str:
    """Integer truncated toward zero, null for NaN and numbers outside the integer range."""
    return f"case when abs({x}) < 2147483648 then cast({x} as int) end"


def decode_qc(x: str) -> str:
    """Quality flag as integer, -1 when undefined.

    Blanks are common and made null first: a failing cast is far slower than a null one.
    """
    return f"coalesce(try_cast(nullif(trim({x}), '') as int), -1)"


def juld_to_timestamp(x: str) -> str:
    """Fractional days since 1950-01-01 to a timestamp cut to seconds.

    Days and day fraction are taken apart first, so the fraction keeps its digits; it is
    rounded to microseconds and then cut. Days outside years 1 to 9999 give null.
    """
    days = f"({clean_numeric(x)})"
    seconds = f"floor(round(({x} - floor({x})) * 86400, 6))"
    return (
        f"case when {days} between {_FIRST_DAY} and {_LAST_DAY} then timestamp_ntz'{EPOCH}' + "
        f"make_dt_interval(cast(floor({x}) as int), 0, 0, cast({seconds} as decimal(18,6))) end"
    )


def parse_datetime14(x: str) -> str:
    """First 14 characters read as yyyyMMddHHmmss; short or invalid gives null."""
    return _datetime14(clean_text(x))


def parse_datetime14_cell(x: str) -> str:
    """``parse_datetime14`` for use inside a lambda."""
    return _datetime14(stripped_cell(x))


def parse_datetime14_array(x: str) -> str:
    """``parse_datetime14`` of each element."""
    return f"transform({x}, t -> {parse_datetime14_cell('t')})"


def _datetime14(text: str) -> str:
    # a text without the 14 digits is left without any, which no cast reads
    iso = (
        f"regexp_replace({text}, '(?s)^(?:([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})([0-9]{{2}})"
        "([0-9]{2})([0-9]{2}).*|.*)$', '$1-$2-$3 $4:$5:$6')"
    )
    return f"try_cast({iso} as timestamp_ntz)"


def classify_source(name: str) -> str:
    """File type from the two-letter prefix of the file name."""
    return (
        f"case when substring({name}, 1, 2) in ('SD', 'SR') then 'synthetic_bgc' "
        f"when substring({name}, 1, 2) in ('BD', 'BR') then 'bgc' else 'core' end"
    )


def build_profile_id(platform: str, cycle: str, direction: str, file_type: str) -> str:
    """``platform_cycle[D][_BGC]``: at least three cycle digits, a null cycle reads 000."""
    return (
        f"concat({platform}, '_', format_string('%03d', coalesce({cycle}, 0)), "
        f"if({direction} = 'D', 'D', ''), if({file_type} = 'synthetic_bgc', '_BGC', ''))"
    )


def geo_point(lat: str, lon: str) -> str:
    """(lon, lat) struct, null unless both are present."""
    return (
        f"case when {lat} is not null and {lon} is not null "
        f"then named_struct('lon', {lon}, 'lat', {lat}) end"
    )


def station_parameters(x: str) -> str:
    """Non-blank parameter names in order, the core three if there are none."""
    names = f"filter({clean_text_array(x)}, t -> t is not null)"
    return f"case when size({names}) > 0 then {names} else array({sql_list(CORE_PARAMS)}) end"


def detect_bgc(stations: str) -> str:
    """Upper-cased biogeochemical names in order, repeats kept; null when there are none."""
    found = f"filter(transform({stations}, t -> upper(t)), t -> t in ({sql_list(BGC_PARAMS)}))"
    return f"case when size({found}) > 0 then {found} end"


def iso_date(x: str) -> str:
    """Timestamp as ISO-8601 text in UTC."""
    return f"date_format({x}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
