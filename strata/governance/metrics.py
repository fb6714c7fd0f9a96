"""Named metrics: SQL expressions over a table that Spark evaluates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from strata.functions.columns import references


@dataclass(frozen=True)
class Metric:
    name: str
    table: str
    expression: str
    keys: tuple[str, ...] = ()


class Registry:
    def __init__(self):
        self.metrics: dict[str, Metric] = {}

    def add(self, metric: Metric) -> None:
        known = self.metrics.get(metric.name)
        if known and known.expression != metric.expression:
            raise ValueError(f"{metric.name} is defined as {known.expression}")
        self.metrics[metric.name] = metric

    def find(self, name: str) -> Metric:
        return self.metrics[name]

    def validate(self, tables: dict[str, DataFrame]) -> list[tuple[str, str]]:
        """(name, problem) of what cannot be evaluated."""
        return [(name, problem) for name, problem, _ in problems(list(self.metrics.values()), tables)]

    def evaluate(self, name: str, tables: dict[str, DataFrame]) -> DataFrame:
        m = self.metrics[name]
        return tables[m.table].groupBy(*m.keys).agg(F.expr(m.expression).alias(m.name))


def problems(metrics: list[Metric], tables: dict[str, DataFrame]) -> list[tuple[str, str, list[str]]]:
    """(name, problem, columns): DUPLICATE where a name has several expressions, MISSING_TABLE, MISSING_COLUMN with the
    columns that the table does not have, INVALID where the parser or the analyser refuses the expression for another
    reason. No job runs: Spark's parser says which columns an expression names, and the analyser what it is worth.
    """
    by_name: dict[str, set[str]] = {}
    for m in metrics:
        by_name.setdefault(m.name, set()).add(m.expression)
    found = [(name, "DUPLICATE", []) for name, expressions in by_name.items() if len(expressions) > 1]
    for m in metrics:
        if m.table not in tables:
            found.append((m.name, "MISSING_TABLE", []))
            continue
        table = tables[m.table]
        known = {c.lower() for c in table.columns}
        try:
            unknown = [name for name in references(table.sparkSession, m.expression) if name.split(".")[0].lower() not in known]
            if unknown:
                found.append((m.name, "MISSING_COLUMN", unknown))
                continue
            table.groupBy(*m.keys).agg(F.expr(m.expression).alias(m.name)).schema  # noqa: B018
        except AnalysisException:
            found.append((m.name, "INVALID", []))
    return found


def registered(rows: DataFrame) -> list[Metric]:
    """Metrics from a table of definitions (name, table, expression): a registry's rows, in order."""
    return [Metric(r["name"], r["table"], r["expression"]) for r in rows.orderBy("name", "table", "expression").toLocalIterator()]
