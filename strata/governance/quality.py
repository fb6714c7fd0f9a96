"""Data quality rules. All rules of one table are measured in one scan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.lake import append

KINDS = ("ROW_COUNT", "UNIQUE", "NOT_NULL", "RANGE", "FRESHNESS", "REFERENTIAL")


@dataclass(frozen=True)
class Rule:
    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    least: float | None = None
    most: float | None = None
    parent: str | None = None
    parent_column: str | None = None
    partition_column: str | None = None
    severity: str = "WARN"
    extra: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"{self.name}: unknown kind {self.kind}")


#: Names under which a rule's bounds may be given.
ALIASES = {"least": ("least", "min", "min_value", "threshold_min"), "most": ("most", "max", "max_value", "threshold", "threshold_max")}


def rule_from(config: dict) -> Rule:
    """A rule from a configuration: bounds under any of their aliases, one column or several, severity WARN if none is
    given, in upper case.
    """
    bound = lambda name: next((float(config[k]) for k in ALIASES[name] if config.get(k) is not None), None)
    columns = config.get("columns") or ([config["column"]] if config.get("column") else [])
    return Rule(config["name"], config["table"], str(config["kind"]).upper(), tuple(columns), bound("least"), bound("most"), config.get("parent"),
        config.get("parent_column"), config.get("partition_column"), str(config.get("severity") or "WARN").upper())


def stale(rows: DataFrame, time: str, now: str, minutes: int = 15) -> DataFrame:
    """latest, minutes since then, and whether a table is stale: one without rows is."""
    latest = rows.agg(F.max(F.col(time).cast("timestamp")).alias("latest"))
    late = ((F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("latest")) / 60).alias("minutes")
    return latest.select("latest", late).withColumn("stale", F.coalesce(F.col("minutes") > minutes, F.lit(True)))


def metric(rule: Rule, today: str) -> Column:
    """The rule's number as an aggregate of its table."""
    column = F.col(rule.columns[0]) if rule.columns else None
    if rule.kind == "ROW_COUNT":
        value = F.count(F.lit(1))
    elif rule.kind == "UNIQUE":
        value = F.count(F.lit(1)) - F.count_distinct(F.struct(*rule.columns))
    elif rule.kind == "NOT_NULL":
        value = F.count_if(column.isNull()) / F.greatest(F.count(F.lit(1)), F.lit(1))
    elif rule.kind == "RANGE":
        outside = F.lit(False)
        if rule.least is not None:
            outside = outside | (column < rule.least)
        if rule.most is not None:
            outside = outside | (column > rule.most)
        value = F.count_if(column.isNotNull() & outside)
    else:
        value = F.datediff(F.lit(today).cast("date"), F.max(column))
    return value.cast("double")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key has no parent; null keys have none to look for."""
    keys = parent.select(F.col(parent_column).alias("__parent")).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__parent"), "left_anti")


def passes(rule: Rule, value: float | None) -> bool:
    if value is None:
        return False
    if rule.kind == "ROW_COUNT":
        return value >= (rule.least if rule.least is not None else 1)
    if rule.kind == "RANGE":
        return value == 0
    return value <= (rule.most if rule.most is not None else 0)


def measure(spark: SparkSession, tables: dict[str, DataFrame], rules: list[Rule], today: str, dt: str | None = None) -> DataFrame:
    """rule, severity, value, passed. A rule that cannot be measured fails, with its error, and the others go on.

    Rules over one table and partition share one aggregation; a rule is on a partition only if it names its column.
    """
    found: list[tuple] = []

    def scope(rule: Rule) -> DataFrame:
        rows = tables[rule.table]
        partitioned = dt and rule.partition_column and rule.kind != "FRESHNESS"
        return rows.where(F.col(rule.partition_column) == dt) if partitioned else rows

    def missing(rule: Rule) -> str | None:
        """What a rule names and the tables don't have; no job is needed to see that."""
        if rule.table not in tables:
            return "MISSING_TABLE"
        own = [*rule.columns, *([rule.partition_column] if dt and rule.partition_column else [])]
        if any(c not in tables[rule.table].columns for c in own):
            return "MISSING_COLUMN"
        if rule.kind == "REFERENTIAL" and (rule.parent not in tables or (rule.parent_column or rule.columns[0]) not in tables[rule.parent].columns):
            return "MISSING_PARENT"
        return None

    def one(rules: list[Rule]) -> None:
        row = scope(rules[0]).agg(*[metric(r, today).alias(f"v{i}") for i, r in enumerate(rules)]).first()
        found.extend((r.name, r.severity, row[i], passes(r, row[i]), None) for i, r in enumerate(rules))

    fused: dict[tuple, list[Rule]] = {}
    found.extend((r.name, r.severity, None, False, why) for r in rules if (why := missing(r)))
    rules = [r for r in rules if not missing(r)]
    for rule in rules:
        if rule.kind != "REFERENTIAL":
            fused.setdefault((rule.table, rule.partition_column if rule.kind != "FRESHNESS" else None), []).append(rule)
    for group in fused.values():
        try:
            one(group)
        except Exception:
            for rule in group:  # find out which of them it was
                try:
                    one([rule])
                except Exception as error:
                    found.append((rule.name, rule.severity, None, False, type(error).__name__))
    for rule in rules:
        if rule.kind == "REFERENTIAL":
            try:
                value = float(orphans(scope(rule), rule.columns[0], tables[rule.parent], rule.parent_column or rule.columns[0]).count())
                found.append((rule.name, rule.severity, value, passes(rule, value), None))
            except Exception as error:
                found.append((rule.name, rule.severity, None, False, type(error).__name__))
    return spark.createDataFrame(found, "rule string, severity string, value double, passed boolean, error string")


def keep_results(results: DataFrame, path: str, run: str) -> int:
    """Adds a run's results to the table of results."""
    return append(results.withColumn("run", F.lit(run)), path, "run")


def blocked(results: DataFrame) -> bool:
    return not results.where("not passed and severity = 'BLOCKER'").isEmpty()
