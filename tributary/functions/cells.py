"""One picked value of a raw record.

A raw record is either a VARIANT (parsed JSON) or a row of typed columns. Rules look at a value
through a `Cell`, which answers what kind of value it is. For a typed column the answer is known
when the plan is built, so the rule shrinks to the one branch that applies and Catalyst prunes the
scan to the picked columns; for a VARIANT the answer is an expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Cell:
    """`value` holds the value, `text` its text; the flags are predicates, or bools when known."""

    value: str
    text: str
    present: str | bool
    is_string: str | bool
    is_number: str | bool
    is_bool: str | bool
    is_integer: str | bool = False
    dtype: T.DataType | None = None
    is_trimmed: bool = False

    @property
    def is_instant(self) -> bool:
        return isinstance(self.dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))

    @property
    def is_null(self) -> str:
        """Absent, or present with a null."""
        return f"{self.text} IS NULL"


def quote(text: str) -> str:
    """A string literal, taken as it is."""
    return "r'" + text + "'" if "'" not in text else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(*steps: str) -> str:
    return ".".join(f"`{step.replace('`', '``')}`" for step in steps)


def one_of(x: str, values) -> str:
    return f"{x} IN ({', '.join(quote(v) for v in values)})"


def choose(*branches: tuple[str | bool, str], otherwise: str) -> str:
    """CASE over branches whose conditions may already be decided while planning."""
    open_branches = []
    for condition, result in branches:
        if condition is True:
            otherwise = result
            break
        if condition is not False:
            open_branches.append(f"WHEN {condition} THEN {result}")
    if not open_branches:
        return otherwise
    return f"CASE {' '.join(open_branches)} ELSE {otherwise} END"


def flag(condition: str | bool) -> str:
    return str(condition).lower() if isinstance(condition, bool) else f"({condition})"


def absent_cell() -> Cell:
    return Cell("NULL", "CAST(NULL AS STRING)", False, False, False, False)


def typed_cell(value: str, dtype: T.DataType) -> Cell:
    """A cell over a column whose type is known; a null counts as a present null."""
    is_string = isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))
    is_bool = isinstance(dtype, T.BooleanType)
    if is_string:
        text = value
    elif is_bool:
        text = f"CASE WHEN {value} THEN 'True' WHEN NOT {value} THEN 'False' END"
    elif isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        text = f"to_json({value})"
    else:
        text = f"CAST({value} AS STRING)"
    return Cell(
        value, text, True, is_string, isinstance(dtype, T.NumericType), is_bool,
        isinstance(dtype, T.IntegralType), dtype,
    )


def is_object(value: str) -> str:
    """True for a JSON object, without walking its fields."""
    return f"(try_variant_get({value}, '$', 'struct<_probe: variant>') IS NOT NULL)"


def in_brackets(text: str) -> str:
    """JSON text as the only element of an array. The parser stops after the first value and would
    overlook text behind it; inside an array it has to read on."""
    return f"concat('[', {text}, ']')"


def strict_json(bracketed: str) -> str:
    """The value of parsed `in_brackets` text; null unless there was exactly one."""
    return (
        f"CASE WHEN try_variant_get({bracketed}, '$[1]', 'variant') IS NULL "
        f"THEN try_variant_get({bracketed}, '$[0]', 'variant') END"
    )


def variant_text(value: str, kind: str) -> str:
    """Text of a JSON scalar; a JSON null has none, and an integral float keeps its `.0`."""
    text = f"CAST({value} AS STRING)"
    return (
        f"CASE WHEN {kind} = 'STRING' THEN {text} WHEN {kind} = 'BOOLEAN' THEN initcap({text}) "
        f"WHEN {kind} RLIKE r'^DECIMAL\\((\\d|1[0-8]),0\\)$' THEN concat({text}, '.0') "
        f"WHEN {kind} <> 'VOID' THEN {text} END"
    )


def variant_cell(value: str, kind: str, text: str) -> Cell:
    """`kind` is STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, OBJECT<..> or ARRAY<..>."""
    number = f"({kind} = 'BIGINT' OR {kind} = 'DOUBLE' OR startswith({kind}, 'DECIMAL') OR {kind} = 'FLOAT')"
    return Cell(
        value, text, f"{kind} IS NOT NULL", f"{kind} = 'STRING'", number, f"{kind} = 'BOOLEAN'",
        f"{kind} = 'BIGINT'", T.VariantType(),
    )


def _inline_variant_cell(value: str) -> Cell:
    kind = f"schema_of_variant({value})"
    return variant_cell(value, kind, variant_text(value, kind))


def pick_variant(root: str, path: str) -> str:
    """The value at a dotted path; null when a step is missing or is not an object."""
    if "'" in path:
        raise ValueError(f"a path may not contain a quote: {path}")
    steps = "".join(f"['{step}']" for step in path.split("."))
    return f'try_variant_get({root}, "${steps}", \'variant\')'


def _apart(names) -> tuple[list[list[str]], dict[str, int]]:
    """Names in groups that hold no two which differ in case only, and the group of each; a struct cannot tell such apart."""
    groups: list[dict[str, str]] = [{}]
    places = {}
    for step in names:
        place = next((g for g, group in enumerate(groups) if step.lower() not in group), len(groups))
        if place == len(groups):
            groups.append({})
        groups[place][step.lower()] = step
        places[step] = place
    return [list(group.values()) for group in groups], places


def _fields(root: str, names: list[str]) -> str:
    """The named fields of a JSON object as a struct of variants; null for anything else."""
    kinds = ", ".join(f"{name(n)}: variant" for n in names or ["_probe"])
    return f"try_variant_get({root}, '$', {quote(f'struct<{kinds}>')})"


def _pick_field(places: dict[str, int], path: str) -> str:
    """The value at a dotted path, of the structs of first steps."""
    first, _, rest = path.partition(".")
    field = name(f"_f{places[first]}", first)
    return pick_variant(field, rest) if rest else field


class Records:
    """Raw records: `column` names the VARIANT that holds each record, or is None for typed columns."""

    def __init__(self, df: DataFrame, column: str | None = None):
        self.df = df
        self.column = column

    def cells(self, paths: dict[str, tuple[str, ...]]) -> tuple[DataFrame, dict[str, Cell]]:
        """Pick each path (the first of its spellings that is present) and name it once.

        VARIANT values are picked in a projection of their own, so rules that use a value several
        times do not pick it several times. All fields come from one walk of the record: a pick by path
        reads the names of the fields anew.
        """
        if self.column is None:
            schema = self.df.schema
            return self.df, {path: _typed(schema, spellings) for path, spellings in paths.items()}
        fields, places = _apart(dict.fromkeys(s.split(".")[0] for spellings in paths.values() for s in spellings))
        whole = [f"{_fields(name(self.column), names)} AS _f{g}" for g, names in enumerate(fields)]
        picks = ["_f0 IS NULL AS _not_object"]
        for i, spellings in enumerate(paths.values()):
            found = [_pick_field(places, s) for s in spellings]
            picks.append(f"{found[0] if len(found) == 1 else 'coalesce(' + ', '.join(found) + ')'} AS _v{i}")
        kinds = [f"schema_of_variant(_v{i}) AS _k{i}" for i in range(len(paths))]
        texts = [f"{variant_text(f'_v{i}', f'_k{i}')} AS _t{i}" for i in range(len(paths))]
        columns = [name(c) for c in self.df.columns]
        df = self.df.selectExpr("*", *whole).selectExpr(*columns, *picks).selectExpr("*", *kinds).selectExpr("*", *texts)
        return df, {path: variant_cell(f"_v{i}", f"_k{i}", f"_t{i}") for i, path in enumerate(paths)}

    def not_an_object(self) -> str:
        """Use after `cells`, which works the flag out next to the picks."""
        return "false" if self.column is None else "_not_object"

    def whole(self) -> str:
        """The raw record as one value, for `payload` later on."""
        return f"struct({', '.join(name(c) for c in self.df.columns)})" if self.column is None else name(self.column)

    def payload(self, whole: str | None = None) -> str:
        """The raw record as JSON text."""
        whole = whole or self.whole()
        return f"to_json({whole})" if self.column is None else f"CAST({whole} AS STRING)"


def _typed(schema: T.StructType, spellings: tuple[str, ...]) -> Cell:
    for path in spellings:
        cell = _typed_path(schema, path)
        if cell is not None:
            return cell
    return absent_cell()


def _typed_path(schema: T.StructType, path: str) -> Cell | None:
    steps = path.split(".")
    dtype: T.DataType = schema
    for depth, step in enumerate(steps):
        if isinstance(dtype, T.VariantType):
            return _inline_variant_cell(pick_variant(name(*steps[:depth]), ".".join(steps[depth:])))
        if not isinstance(dtype, T.StructType) or step not in dtype.fieldNames():
            return None
        dtype = dtype[step].dataType
    if isinstance(dtype, T.VariantType):
        return _inline_variant_cell(name(*steps))
    return typed_cell(name(*steps), dtype)


def selected(df: DataFrame, keep: tuple[str, ...], columns: dict[str, str]) -> DataFrame:
    """A projection of the kept columns and of the named expressions."""
    return df.selectExpr(*[name(k) for k in keep], *[f"{sql} AS {name(alias)}" for alias, sql in columns.items()])


