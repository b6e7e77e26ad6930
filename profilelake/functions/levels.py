"""Array expressions over the levels, calibration grid and history of one raw profile."""

from profilelake.functions.cleaning import (
    clean_numeric,
    clean_text_array,
    decode_qc,
    parse_datetime14_array,
)
from profilelake.schema import (
    BGC_PARAMS,
    CALIBRATION_TEXT,
    CORE_PARAMS,
    HISTORY_NUMBERS,
    HISTORY_TEXT,
    LEVEL,
    PARAMS,
    PARTS,
    QC_PARTS,
    RAW_OTHER,
)

_OTHERS = f"array<{RAW_OTHER.simpleString()}>"
_CALIBRATION_TYPE = "array<struct<parameter:string,{},date:timestamp_ntz>>".format(
    ",".join(f"{c}:string" for c in CALIBRATION_TEXT)
)


def wanted_param(param: str, measured: str) -> str:
    """The raw struct of a parameter, null unless the upper-case ``measured`` list has it."""
    return f"case when array_contains({measured}, '{param}') then {param.lower()} end"


def wanted_others(measured: str) -> str:
    """The raw parameters outside the catalogue that the ``measured`` list has, null if none."""
    known = ", ".join(f"'{p}'" for p in PARAMS)
    return (
        f"nullif(filter(other_params, p -> array_contains({measured}, upper(p.name)) "
        f"and upper(p.name) not in ({known})), cast(array() as {_OTHERS}))"
    )


def _others(raw_pres: str) -> str:
    """Per level, the parameters outside the catalogue, cleaned; empty without any."""
    fields = ["lower(p.name) as name"]
    for part in PARTS:
        clean = decode_qc if part in QC_PARTS else clean_numeric
        fields.append(f"case when i < size(p.{part}) then {clean(f'get(p.{part}, i)')} end as {part}")
    each = f"transform(other_params, p -> struct({', '.join(fields)}))"
    return (
        f"case when other_params is null or size({raw_pres}) = 0 "
        f"then cast(array() as array<{LEVEL['others'].dataType.simpleString()}>) "
        f"else transform(sequence(0, size({raw_pres}) - 1), i -> {each}) end"
    )


def assemble_levels(raw_pres: str) -> str:
    """Zip the cleaned arrays of the wanted parameters into level structs.

    Parameters outside the catalogue become a list of named values of the level, null if the
    profile has none.

    The raw pressure array sets the number of levels; without one there are no levels.
    Arrays are cleaned before they are zipped, so a parameter that a file lacks costs
    nothing per level.
    """
    arrays = []
    for param in PARAMS:
        for part, suffix in PARTS.items():
            kind = LEVEL[param.lower() + suffix].dataType.simpleString()
            clean = decode_qc("v") if part in QC_PARTS else clean_numeric("v")
            arrays.append(
                f"coalesce(transform({param.lower()}.{part}, v -> {clean}), "
                f"cast(array() as array<{kind}>))"
            )
    arrays.append(_others(raw_pres))
    zipped = f"slice(arrays_zip({', '.join(arrays)}), 1, size({raw_pres}))"
    return (
        f"case when {raw_pres} is not null then cast({zipped} as array<{LEVEL.simpleString()}>) "
        f"else cast(array() as array<{LEVEL.simpleString()}>) end"
    )


def available_vars() -> str:
    """Names of the raw variables that exist for the wanted parameters.

    Marks absent parts with an empty name and removes those: unlike a filter lambda, all
    of it compiles, and an absent parameter costs one test.
    """
    groups = []
    for param in PARAMS:
        name = param.lower()
        parts = ", ".join(
            f"if({name}.{part} is not null, '{name}{suffix}', '')" for part, suffix in PARTS.items()
        )
        groups.append(f"if({name} is null, cast(array() as array<string>), array({parts}))")
    parts = ", ".join(
        f"if(p.{part} is not null, concat(lower(p.name), '{suffix}'), '')"
        for part, suffix in PARTS.items()
    )
    groups.append(
        f"if(other_params is null, cast(array() as array<string>), "
        f"flatten(transform(other_params, p -> array({parts}))))"
    )
    return f"array_remove(flatten(array({', '.join(groups)})), '')"


def filter_levels(levels: str, file_type: str) -> str:
    """Levels with a raw core value or, in BGC files, a raw BGC value.

    ``levels`` is a column named twice, so Spark makes it in a step of its own, compiled but for
    the lambdas over its arrays; inside ``filter`` nothing of it would be.
    """

    def any_of(params: list[str]) -> str:
        return f"coalesce({', '.join(f'm.{p.lower()}' for p in params)}) is not null"

    kept = (
        f"filter({levels}, m -> {any_of(CORE_PARAMS)} or "
        f"({file_type} in ('synthetic_bgc', 'bgc') and {any_of(BGC_PARAMS)}))"
    )
    return f"if(size({levels}) > 0, {kept}, {levels})"


def max_pres(levels: str) -> str:
    """Greatest non-null raw pressure."""
    return f"array_max({levels}.pres)"


def _or_empty(array: str, kind: str) -> str:
    return f"coalesce({array}, cast(array() as array<{kind}>))"


def flatten_calibration() -> str:
    """The calibration grid as a list of entries, blank parameters left out."""

    def cells(name: str) -> str:
        return f"get(calib_{name}, i)"

    # each row's arrays are cleaned whole and zipped; a cell beyond the names has none
    arrays = [clean_text_array("row")]
    arrays += [_or_empty(clean_text_array(cells(c)), "string") for c in CALIBRATION_TEXT]
    arrays.append(_or_empty(parse_datetime14_array(cells("date")), "timestamp_ntz"))
    grid = f"transform(calib_parameter, (row, i) -> cast(arrays_zip({', '.join(arrays)}) as {_CALIBRATION_TYPE}))"
    entries = f"filter(flatten({grid}), e -> e.parameter is not null)"
    return f"coalesce({entries}, cast(array() as {_CALIBRATION_TYPE}))"


def flatten_history() -> str:
    """History records whose institution is not blank."""
    texts = [c for c in HISTORY_TEXT if c != "institution"]
    kinds = [f"{c}:string" for c in ["institution", *texts]] + ["date:timestamp_ntz"]
    kind = f"array<struct<{','.join(kinds + [f'{c}:double' for c in HISTORY_NUMBERS])}>>"
    # the arrays are cleaned whole and zipped; a cell beyond the institutions has none
    arrays = [clean_text_array("history_institution")]
    arrays += [_or_empty(clean_text_array(f"history_{c}"), "string") for c in texts]
    arrays.append(_or_empty(parse_datetime14_array("history_date"), "timestamp_ntz"))
    arrays += [
        _or_empty(f"transform(history_{c}, v -> {clean_numeric('v')})", "double") for c in HISTORY_NUMBERS
    ]
    entries = f"filter(cast(arrays_zip({', '.join(arrays)}) as {kind}), e -> e.institution is not null)"
    return f"coalesce({entries}, cast(array() as {kind}))"
