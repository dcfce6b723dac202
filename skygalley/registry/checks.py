"""All quality rules of the warehouse, of the older star schema, and of the forecast input."""

from __future__ import annotations

from collections.abc import Sequence


from skygalley.forecast.preparation import validation_report
from skygalley.operators.quality import (
    Accepted,
    Expression,
    NoRows,
    NotNull,
    Relationship,
    Rule,
    Unique,
    check_rules,
    failing_rows,
    label,
)
from skygalley.plans import rules
from skygalley.registry.base import Lab, query, register
from skygalley.registry.forecast import features


def _failures(rule: Rule, prefix: str) -> str:
    """The number of failures of a rule as a SQL scalar."""
    t = f"{prefix}{rule.table}"
    if isinstance(rule, NotNull):
        extra = f" AND ({rule.where})" if rule.where else ""
        return f"SELECT count(*) FROM {t} WHERE {rule.column} IS NULL{extra}"
    if isinstance(rule, Unique):
        columns = ", ".join(rule.columns)
        present = f" WHERE {rule.columns[0]} IS NOT NULL" if rule.single else ""
        return f"SELECT count(*) FROM (SELECT 1 FROM {t}{present} GROUP BY {columns} HAVING count(*) > 1)"
    if isinstance(rule, Relationship):
        return (
            f"SELECT count(*) FROM {t} c WHERE c.{rule.column} IS NOT NULL AND NOT EXISTS"
            f" (SELECT 1 FROM {prefix}{rule.parent} p WHERE p.{rule.parent_column} = c.{rule.column})"
        )
    if isinstance(rule, Accepted):
        values = ", ".join(f"'{v}'" for v in rule.values)
        return f"SELECT count(DISTINCT {rule.column}) FROM {t} WHERE {rule.column} NOT IN ({values})"
    if isinstance(rule, Expression):
        return f"SELECT count(*) FROM {t} WHERE NOT ({rule.predicate})"
    if isinstance(rule, NoRows):
        return f"SELECT count(*) FROM {t} WHERE {rule.condition}"
    raise TypeError(rule)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql(chosen: Sequence[Rule], prefix: str = "") -> str:
    rows = []
    for rule in chosen:
        kind, about = label(rule)
        rows.append(
            f"SELECT {_text(rule.table)} AS table_name, {_text(kind)} AS rule, {_text(about)} AS subject,"
            f" ({_failures(rule, prefix)}) AS failures"
        )
    return "\nUNION ALL ".join(rows)


for _name, _rules in (
    ("dq_not_null", rules.NOT_NULL),
    ("dq_unique", rules.UNIQUE),
    ("dq_relationship", rules.RELATIONSHIPS),
    ("dq_accepted", rules.ACCEPTED),
    ("dq_expression", rules.EXPRESSIONS),
    ("dq_business", rules.BUSINESS),
):
    register(_name, lambda lab, r=_rules: check_rules(lab.wh.ref, r), _sql(_rules))

register(
    "dq_unique_combo",
    lambda lab: check_rules(lab.wh.once, rules.UNIQUE_TOGETHER),
    _sql(rules.UNIQUE_TOGETHER),
)
register(
    "dq_legacy_pk_fk",
    lambda lab: check_rules(lab.legacy.ref, rules.LEGACY),
    _sql(rules.LEGACY, "leg_"),
)


@query(
    "dq_failing_rows",
    "SELECT flight_no, date, origin, class FROM stg_pax WHERE NOT (origin LIKE 'city%')",
)
def _rows(lab: Lab):
    rule = Expression("stg_pax", "origin like 'city%'")
    return failing_rows(lab.wh.ref("stg_pax"), rule).select("flight_no", "date", "origin", "class")


@query(
    "dq_fcst",
    """SELECT count(*) FILTER (flight_key IS NULL) AS null_flight_key, count(*) FILTER (origin IS NULL) AS null_origin,
       count(*) FILTER (destination IS NULL) AS null_destination, count(*) FILTER (date IS NULL) AS null_date,
       count(*) FILTER (item_id IS NULL) AS null_item_id, count(*) FILTER (sold_quantity IS NULL) AS null_sold_quantity,
       count(*) FILTER (number_of_passengers IS NULL) AS null_number_of_passengers,
       count(*) FILTER (is_night IS NULL) AS null_is_night, count(*) FILTER (sold_quantity < 0) AS negative_target,
       count(*) FILTER (hist_avg IS NULL) AS no_average,
       count(*) FILTER (coalesce(hist_level_used NOT IN (1, 2, 3, 4), true)) AS bad_level,
       min(date) AS first_date, max(date) AS last_date FROM fc_features""",
)
def _forecast_input(lab: Lab):
    return validation_report(features(lab), lab.forecast)


