"""Null and sentinel column profile, and the nested drop it drives.

The profile is one aggregate over the frame: for every leaf field (nested structs
and arrays of structs included) it counts the rows holding a value and tests
whether any value falls outside the configured sentinel set. Nothing but one row of
flags comes back to the driver, whatever the size of the frame.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import utrim

# The sentinel rule examines these leaf types only; every type is subject to the
# all-null rule.
_STRING_TYPES = (T.StringType,)
_NUMBER_TYPES = (T.IntegerType, T.LongType, T.DoubleType)


@dataclass(frozen=True)
class Leaf:
    names: tuple[str, ...]   # e.g. ("meta", "lang"); a name may itself hold a dot
    data_type: T.DataType
    expr: Column         # scalar value, or an array of values below an array of struct
    in_array: bool

    @property
    def path(self) -> str:
        """For display: names joined by dots, quoted where they hold a dot or a backtick."""
        return ".".join(_quote(n) if "." in n or "`" in n else n for n in self.names)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _field_getter(name: str):
    # higher-order functions look at the lambda's arity, so bind extra values by closure
    return lambda x: x[name]


def leaves(schema: T.StructType) -> list[Leaf]:
    out: list[Leaf] = []

    def walk(dtype: T.DataType, names: tuple[str, ...], expr: Column, in_array: bool) -> None:
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                if not names:
                    sub = F.col(_quote(f.name))
                elif in_array:
                    sub = F.transform(expr, _field_getter(f.name))
                else:
                    sub = expr[f.name]
                walk(f.dataType, (*names, f.name), sub, in_array)
        elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
            # an array of struct below another array: one flat array of elements
            walk(dtype.elementType, names, F.flatten(expr) if in_array else expr, True)
        else:
            out.append(Leaf(names, dtype, expr, in_array))

    walk(schema, (), None, False)
    return out


def _lit_set(values: Iterable) -> tuple[list, bool]:
    vals = list(values)
    return [v for v in vals if v is not None], any(v is None for v in vals)


def _outside(value: Column, dtype: T.DataType, null_strings, null_numbers) -> Column | None:
    """Predicate 'value is not a sentinel' for a scalar value; None when the type is
    not examined by the sentinel rule."""
    if isinstance(dtype, _STRING_TYPES):
        members, null_member = _lit_set(null_strings)
        v = utrim(value)
    elif isinstance(dtype, _NUMBER_TYPES):
        members, null_member = _lit_set(null_numbers)
        v = value
    else:
        return None
    in_set = v.isin(members) if members else F.lit(False)
    return F.when(value.isNull(), F.lit(not null_member)).otherwise(~in_set)


def _outside_fn(dtype, null_strings, null_numbers):
    return lambda x: _outside(x, dtype, null_strings, null_numbers)


def profile(df: DataFrame, null_strings: Iterable = (), null_numbers: Iterable = (),
            drop_all_null: bool = True) -> DataFrame:
    """One row per leaf: ``path, data_type, n_rows, n_with_value, only_sentinels, drop``.

    ``drop`` is true for a ``void`` leaf, for a leaf without any value when
    ``drop_all_null`` is set, and for a string / int / bigint / double leaf whose
    values (trimmed strings; null counts as a value) all lie in the sentinel set.
    An empty frame drops nothing."""
    flat = profile_counts(df, null_strings, null_numbers)
    return profile_of_counts(flat, df.schema, null_strings, null_numbers, drop_all_null)


def profile_counts(df: DataFrame, null_strings: Iterable = (), null_numbers: Iterable = ()) -> DataFrame:
    """The counters behind a profile, as one row: ``n_rows`` and, for leaf i of the schema, the rows with a value
    ``v<i>`` and whether any value lies outside the sentinel set ``b<i>``. Rows of several parts of a
    table merge by ``merge_counts``."""
    null_strings, null_numbers = tuple(null_strings), tuple(null_numbers)
    lv = leaves(df.schema)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, leaf in enumerate(lv):
        if leaf.in_array:
            has = F.exists(leaf.expr, lambda x: x.isNotNull())
        else:
            has = leaf.expr.isNotNull()
        aggs.append(F.count_if(F.coalesce(has, F.lit(False))).alias(f"v{i}"))
        if leaf.in_array:
            out = _outside(F.lit(None).cast(leaf.data_type), leaf.data_type, null_strings, null_numbers)
            if out is not None:
                bad = F.when(leaf.expr.isNull(), out).otherwise(
                    F.exists(leaf.expr, _outside_fn(leaf.data_type, null_strings, null_numbers)))
            else:
                bad = None
        else:
            bad = _outside(leaf.expr, leaf.data_type, null_strings, null_numbers)
        aggs.append((F.bool_or(bad) if bad is not None else F.lit(True)).alias(f"b{i}"))
    return df.agg(*aggs)


def merge_counts(counts: DataFrame) -> DataFrame:
    """One row of counters from those of several parts of a table (none: null flags and no rows)."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counts.columns if not c.startswith("b")]
    return counts.agg(*sums, *(F.bool_or(c).alias(c) for c in counts.columns if c.startswith("b"))).select(counts.columns)


def profile_of_counts(flat: DataFrame, schema: T.StructType, null_strings: Iterable = (), null_numbers: Iterable = (),
                      drop_all_null: bool = True) -> DataFrame:
    """The profile that one row of counters stands for."""
    null_strings, null_numbers = tuple(null_strings), tuple(null_numbers)
    lv = leaves(schema)
    rows = []
    for i, leaf in enumerate(lv):
        examined = _outside(F.lit(None), leaf.data_type, null_strings, null_numbers) is not None
        only_sent = (F.lit(examined) & ~F.coalesce(F.col(f"b{i}"), F.lit(False)))
        is_void = isinstance(leaf.data_type, T.NullType)
        drop = (F.col("n_rows") > 0) & (
            F.lit(is_void) | (F.lit(drop_all_null) & (F.col(f"v{i}") == 0)) | only_sent)
        rows.append(F.struct(
            F.lit(leaf.path).alias("path"),
            F.lit(leaf.data_type.simpleString()).alias("data_type"),
            F.col("n_rows"),
            F.col(f"v{i}").alias("n_with_value"),
            only_sent.alias("only_sentinels"),
            drop.alias("drop")))
    return flat.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _touched(prefix: tuple[str, ...], gone: set) -> bool:
    return any(p[:len(prefix)] == prefix for p in gone)


def _survives(dtype: T.DataType, prefix: tuple[str, ...], gone: set) -> bool:
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        return _survives(dtype.elementType, prefix, gone)
    if isinstance(dtype, T.StructType):
        return any(_survives(f.dataType, (*prefix, f.name), gone) for f in dtype.fields)
    return prefix not in gone


def _drop_paths(dtype: T.DataType, expr: Column, prefix: tuple[str, ...], gone: set) -> Column | None:
    """Rebuild ``expr`` without the leaf paths in ``gone``; None when nothing is left."""
    if not _touched(prefix, gone):
        return expr
    if not _survives(dtype, prefix, gone):
        return None
    if isinstance(dtype, T.ArrayType):
        et = dtype.elementType
        return F.transform(expr, lambda x: _drop_paths(et, x, prefix, gone))
    kept = [(f.name, _drop_paths(f.dataType, expr[f.name], (*prefix, f.name), gone))
            for f in dtype.fields if _survives(f.dataType, (*prefix, f.name), gone)]
    return F.when(expr.isNull(), F.lit(None)).otherwise(F.struct(*[e.alias(n) for n, e in kept]))


def drop_fields(df: DataFrame, paths: Iterable[str | tuple[str, ...]]) -> DataFrame:
    """Drop leaf paths, inside structs and arrays of structs too; a parent whose
    children all go is dropped as well. A path is a tuple of names, or the display form
    of the profile (a name that holds a dot is quoted there)."""
    by_path = {leaf.path: leaf.names for leaf in leaves(df.schema)}
    gone = {by_path.get(p, (p,)) if isinstance(p, str) else tuple(p) for p in paths}
    cols = []
    for f in df.schema.fields:
        e = _drop_paths(f.dataType, F.col(_quote(f.name)), (f.name,), gone)
        if e is not None:
            cols.append(e.alias(f.name))
    return df.select(*cols)


def drop_null_fields(df: DataFrame, null_strings: Iterable = (), null_numbers: Iterable = (),
                     drop_all_null: bool = True) -> DataFrame:
    """Profile the frame (one aggregate job), then drop the flagged leaves."""
    prof = profile(df, null_strings, null_numbers, drop_all_null)
    gone = [r["path"] for r in prof.where("drop").select("path").collect()]
    return drop_fields(df, gone)
