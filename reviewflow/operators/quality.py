"""Data-quality rules evaluated as one aggregate.

A rule is ``(metric, op, threshold)`` or ``(metric, column, op, threshold)``; metrics
are ``ColumnCount`` (from the schema, no job), ``RowCount`` and ``Completeness`` (the
non-null share of a column); ``with_outcomes`` adds ``ColumnValues`` and ``ColumnLength`` and says for each row
which rules it fails. A rule set may also be text: ``Rules = [ColumnCount > 0,
Completeness "title" >= 0.8]``. The result is a small rule table; by default a failed
rule is reported, not raised, and never blocks the write that follows.
"""

from __future__ import annotations

import operator
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the rule set of the ETL job.
DEFAULT_RULES = (("ColumnCount", ">", 0),)

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
        "=": operator.eq, "==": operator.eq, "!=": operator.ne}


def _parts(rule):
    if len(rule) == 3:
        metric, op, thr = rule
        return metric, None, op, thr
    return rule


def _label(rule) -> str:
    metric, col, op, thr = _parts(rule)
    target = f' "{col}"' if col else ""
    return f"{metric}{target} {op} {thr}"


_RULE = re.compile(r'\s*(\w+)(?:\s+"([^"]+)")?\s*(>=|<=|!=|==|=|>|<)\s*(-?[\d.]+)\s*')


def parse_rules(text: str) -> tuple:
    """The rules of a rule-set text."""
    whole = re.fullmatch(r"\s*Rules\s*=\s*\[(.*)\]\s*", text, re.S)
    if whole is None:
        raise ValueError("a rule set reads Rules = [rule, ...]")
    out = []
    for part in filter(str.strip, whole[1].split(",")):
        m = _RULE.fullmatch(part)
        if m is None:
            raise ValueError(f"not a rule: {part.strip()}")
        threshold = float(m[4]) if "." in m[4] else int(m[4])
        out.append((m[1], m[2], m[3], threshold) if m[2] else (m[1], m[3], threshold))
    return tuple(out)


def evaluate(df: DataFrame, rules=DEFAULT_RULES, on_fail: str = "report") -> DataFrame:
    """Rule table ``rule, observed, outcome`` (outcome ``Passed`` / ``Failed``)."""
    if isinstance(rules, str):
        rules = parse_rules(rules)
    exprs = [F.count(F.lit(1)).alias("__rows")]
    for i, rule in enumerate(rules):
        metric, col, _, _ = _parts(rule)
        if metric == "Completeness":
            exprs.append(F.count(F.col(col)).alias(f"__c{i}"))
    row = None
    if any(_parts(r)[0] != "ColumnCount" for r in rules):
        row = df.agg(*exprs).collect()[0]   # one row of counters
    counts = {_parts(r)[1]: row[f"__c{i}"] for i, r in enumerate(rules) if _parts(r)[0] == "Completeness"}
    return from_counts(df.sparkSession, rules, len(df.columns), row["__rows"] if row else 0, counts, on_fail)


def from_counts(spark, rules, n_columns: int, n_rows: int, with_value: dict, on_fail: str = "report") -> DataFrame:
    """The rule table from counters that are known already (``with_value``: column -> rows with a value)."""
    rules = parse_rules(rules) if isinstance(rules, str) else rules
    out = []
    for rule in rules:
        metric, col, op, thr = _parts(rule)
        if metric == "ColumnCount":
            observed = float(n_columns)
        elif metric == "RowCount":
            observed = float(n_rows)
        elif metric == "Completeness":
            observed = float(with_value[col]) / n_rows if n_rows else 0.0
        else:
            raise ValueError(f"unknown metric {metric}")
        passed = _OPS[op](observed, thr)
        if not passed and on_fail == "raise":
            raise ValueError(f"data-quality rule failed: {_label(rule)} (observed {observed})")
        out.append((_label(rule), observed, "Passed" if passed else "Failed"))
    return spark.createDataFrame(out, "rule string, observed double, outcome string")


# ---- outcomes by row -------------------------------------------------------------------

#: Column of ``with_outcomes``: the labels of the rules that a row fails.
FAILED_COLUMN = "failed_rules"
_ROW_METRICS = ("Completeness", "ColumnValues", "ColumnLength")


def _row_check(rule):
    """Whether a row meets the rule: ``Completeness`` asks for a value, ``ColumnValues`` and ``ColumnLength``
    compare the value or its length (null fails)."""
    metric, col, op, threshold = _parts(rule)
    if metric == "Completeness":
        return F.col(col).isNotNull()
    left = F.length(col) if metric == "ColumnLength" else F.col(col)
    return F.coalesce(_OPS[op](left, F.lit(threshold)), F.lit(False))


def with_outcomes(df: DataFrame, rules) -> DataFrame:
    """``df`` with ``failed_rules``: the labels of the row rules (``Completeness``, ``ColumnValues``,
    ``ColumnLength``) that each row fails, in the order of the rules. Rules of the whole table are left to
    ``outcomes``. It is an expression, so the data and its outcomes are written in one pass."""
    rules = parse_rules(rules) if isinstance(rules, str) else rules
    checks = [F.when(~_row_check(r), F.lit(_label(r))) for r in rules if _parts(r)[0] in _ROW_METRICS]
    failed = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
    return df.withColumn(FAILED_COLUMN, failed)


def outcomes(checked: DataFrame, rules) -> DataFrame:
    """Rule table ``rule, observed, failed_rows, outcome`` by aggregation of a frame that ``with_outcomes``
    made (read back, it costs a scan of one column). ``observed`` is the count for rules of the whole
    table, else the share of rows that pass; ``Completeness`` passes by its threshold, the other row rules
    only if every row does. Without rows no row rule passes but those of every row."""
    rules = parse_rules(rules) if isinstance(rules, str) else rules
    named = [_label(r) for r in rules]
    row = checked.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.array_contains(FAILED_COLUMN, n)).alias(f"f{i}")
                                                      for i, n in enumerate(named))).first()
    out = []
    for i, rule in enumerate(rules):
        metric, _, op, threshold = _parts(rule)
        failed = None
        if metric in _ROW_METRICS:
            failed = row[f"f{i}"]
            observed = (row["n"] - failed) / row["n"] if row["n"] else 0.0
            passed = _OPS[op](observed, threshold) if metric == "Completeness" else failed == 0
        else:
            observed = float(len(checked.columns) - 1 if metric == "ColumnCount" else row["n"])
            passed = _OPS[op](observed, threshold)
        out.append((named[i], float(observed), failed, "Passed" if passed else "Failed"))
    return checked.sparkSession.createDataFrame(out, "rule string, observed double, failed_rows long, outcome string")
