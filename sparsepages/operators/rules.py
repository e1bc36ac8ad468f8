"""Field rules over a whole table: a report, and a split into clean and bad rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparsepages.functions.validation import Rule, applies, field_text, rule_passes, trimmed
from sparsepages.operators.once import computed_once


def _prepared(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, list[Column]]:
    """The table with the text forms its rules share, and one test per rule.

    Two projections, so that each text is cleaned and trimmed once for all
    rules on its column.
    """
    texts = [
        c
        for c in dict.fromkeys(r.column for r in rules if r.test is None and r.name != "equalTo")
        if isinstance(df.schema[c].dataType, T.StringType)
    ]
    table = df.withColumns({f"__text_{c}": field_text(F.col(c)) for c in texts}) if texts else df
    table = table.withColumns({f"__bare_{c}": trimmed(F.col(f"__text_{c}")) for c in texts}) if texts else table
    tests = []
    for rule in rules:
        shared = (F.col(f"__text_{rule.column}"), F.col(f"__bare_{rule.column}")) if rule.column in texts else ()
        passes, where = rule_passes(rule, df.schema[rule.column].dataType, *shared), applies(rule)
        tests.append(passes if where is None else ~where | passes)
    return table, tests


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows checked and rows failed per rule, all rules in one pass.

    A rule with a condition checks the rows that meet it. The aggregate leaves
    one row, which is then turned into one per rule.
    """
    table, tests = _prepared(df, rules)
    failed = [F.count(F.when(~test, 1)).alias(f"f{i}") for i, test in enumerate(tests)]
    checked = [F.count("*" if (where := applies(rule)) is None else F.when(where, 1)).alias(f"c{i}") for i, rule in enumerate(rules)]
    totals = table.agg(*checked, *failed)
    lines = F.array(
        *[
            F.struct(
                F.lit(rule.column).alias("col"),
                F.lit(rule.name).alias("rule"),
                F.col(f"c{i}").alias("checked"),
                F.col(f"f{i}").alias("failed"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return totals.select(F.inline(lines))


# Rules tested in one step of the plan. Spark writes each step as a method of
# its own, and the JVM leaves methods of many rules uncompiled.
_RULES_PER_STEP = 2


def tag_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``failures``, one field per checked column holding its first failing
    rule, and ``first_failure``, the first of those; fields go in the order in
    which the rules name them, and NULL means all is well.
    """
    table, tests = _prepared(df, rules)
    columns = list(dict.fromkeys(rule.column for rule in rules))
    fields = []
    for column in columns:
        fails = [F.when(~test, rule.name) for rule, test in zip(rules, tests) if rule.column == column]
        steps = [fails[at : at + _RULES_PER_STEP] for at in range(0, len(fails), _RULES_PER_STEP)]
        names = [f"__failed_{column}_{i}" for i in range(len(steps))]
        for name, step in zip(names, steps):
            table = computed_once(table, name, F.coalesce(*step))
        fields.append(F.coalesce(*names).alias(column))
    failures = table.select(*df.columns, F.struct(*fields).alias("failures"))
    return failures.withColumn("first_failure", F.coalesce(*[F.col("failures")[c] for c in columns]))


def rule_quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that meet every rule, untouched, and tagged rows that do not."""
    tagged = tag_failures(df, rules)
    clean = tagged.filter(F.col("first_failure").isNull()).select(*df.columns)
    return clean, tagged.filter(F.col("first_failure").isNotNull())
