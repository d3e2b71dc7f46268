"""Row rules, key rules and their reports.

All rules of a table run in one aggregation.  Rules across tables count rows per
licence and day first, so a hot licence reaches the window as one row per day.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.columns import is_accepted_price, is_accepted_type, share, unit_price
from tallyspan.operators.dedup import flag_first_occurrence
from tallyspan.operators.skew import hot_safe_join
from tallyspan.operators.spine import calendar_bounds, densify, with_bounds
from tallyspan.schemas import CHANGES_SCHEMA, INITIAL_SCHEMA, MART_COLUMNS

CHANGES = "license_changes"
ENTITIES = "initial_licenses"
SKETCH_LOG_K = 12


@dataclass(frozen=True)
class Rule:
    """A named row predicate; a NULL answer counts as failed."""

    name: str
    table: str
    holds: Callable[[], Column]

    def passed(self) -> Column:
        return F.coalesce(self.holds(), F.lit(False))


VALIDATION_RULES = [
    Rule("change_type_accepted", CHANGES, lambda: is_accepted_type(F.col("type"))),
    Rule("change_price_in_range", CHANGES, lambda: is_accepted_price(F.col("price"))),
    Rule("entity_type_accepted", ENTITIES, lambda: is_accepted_type(F.col("type"))),
    Rule("entity_price_in_range", ENTITIES, lambda: is_accepted_price(F.col("price"))),
]


def _complete(names: Sequence[str]) -> Column:
    return F.forall(F.array(*[F.col(n).isNotNull() for n in names]), lambda ok: ok)


def consistency_rules(as_of: date) -> list[Rule]:
    """Properties that generated tables must have; ``as_of`` stands for today."""
    today = date(as_of.year, as_of.month, as_of.day)
    rules: list[Rule] = []
    for table, prefix, day, key, schema in (
        (ENTITIES, "entity", "creation_date", "customer_id", INITIAL_SCHEMA),
        (CHANGES, "change", "date", "license_id", CHANGES_SCHEMA),
    ):
        names = schema.fieldNames()
        rules += [
            Rule(f"{prefix}_no_missing_values", table, lambda names=names: _complete(names)),
            Rule(f"{prefix}_price_positive", table, lambda: F.col("price") > 0),
            Rule(f"{prefix}_price_matches_type", table, lambda: F.col("price") == unit_price(F.col("type"))),
            Rule(f"{prefix}_not_in_future", table, lambda day=day: F.col(day) <= F.lit(today)),
            Rule(f"{prefix}_{key}_positive", table, lambda key=key: F.col(key) > 0),
            Rule(f"{prefix}_renewable_is_boolean", table, lambda: F.col("renewable").isin(True, False)),
        ]
    return [*rules, Rule("entity_type_accepted", ENTITIES, lambda: is_accepted_type(F.col("type")))]


def _as_report(totals: DataFrame, entries: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """One-row totals to one report row per (rule, table, checked, failed)."""
    rows = ", ".join(
        f"struct('{rule}' AS rule, '{table}' AS table_name, coalesce({checked}, 0L) AS checked, "
        f"coalesce({failed}, 0L) AS failed)"
        for rule, table, checked, failed in entries
    )
    return totals.selectExpr(f"inline(array({rows}))").withColumn(
        "failed_ratio", share(F.col("failed"), F.col("checked"))
    )


def _union(reports: Sequence[DataFrame]) -> DataFrame:
    merged = reports[0]
    for report in reports[1:]:
        merged = merged.unionByName(report)
    return merged


def row_rule_report(df: DataFrame, table: str, rules: Sequence[Rule], unique_id: str | None = None) -> DataFrame:
    """Failure count and ratio of every row rule of one table, in one pass.

    ``unique_id`` names an extra rule: every row of an ``id`` after its first fails.
    """
    own = [r for r in rules if r.table == table]
    counts = [F.count("*").alias("checked"), *[F.count_if(~r.passed()).alias(f"f{i}") for i, r in enumerate(own)]]
    entries = [(r.name, table, "checked", f"f{i}") for i, r in enumerate(own)]
    if unique_id:
        null_copies = F.greatest(F.count_if(F.col("id").isNull()) - 1, F.lit(0))
        counts.append((F.count("id") - F.countDistinct("id") + null_copies).alias("copies"))
        entries.append((unique_id, table, "checked", "copies"))
    return _as_report(df.agg(*counts), entries)


def entity_keys(initial: DataFrame) -> DataFrame:
    """One row per entity id: earliest creation date and number of rows."""
    return initial.groupBy(F.col("id").alias("license_id")).agg(
        F.min("creation_date").alias("creation_date"), F.count("*").alias("n_rows")
    )


def quality_totals(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """One row of counts behind ``quality_report``.  They are sums over licences, so the totals of
    some licences' rows before and after a change say what it does to the totals of all.

    One scan of each table: the rows of both are counted per licence and day, with the
    failures of their row rules.  A window over these counts, at most one row per day
    for each licence, then answers the rules that compare the two tables.
    """
    rules = {r.name: r for r in VALIDATION_RULES}
    names = list(rules)

    def tagged(df: DataFrame, table: str, key: str, day: str) -> DataFrame:
        fails = [
            (~r.passed()).cast("int").alias(n) if r.table == table else F.lit(0).alias(n) for n, r in rules.items()
        ]
        own = F.lit(int(table == CHANGES)).alias("change"), F.lit(int(table == ENTITIES)).alias("entity")
        return df.select(F.col(key).alias("license_id"), F.col(day).alias("date"), *own, *fails)

    rows = tagged(changes, CHANGES, "license_id", "date").union(tagged(initial, ENTITIES, "id", "creation_date"))
    daily = rows.groupBy("license_id", "date").agg(*[F.sum(c).alias(c) for c in ("change", "entity", *names)])
    by_day = "OVER (PARTITION BY license_id ORDER BY date"
    so_far = f"{by_day} ROWS UNBOUNDED PRECEDING)"
    whole = f"{by_day} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    seen = daily.selectExpr(
        "*",
        f"max(license_id IS NOT NULL AND date IS NOT NULL AND entity > 0) {so_far} AS created",
        f"license_id IS NOT NULL AND max(entity > 0) {whole} AS has_entity",
        f"license_id IS NOT NULL AND max(change > 0) {whole} AS has_change",
        f"max(entity > 0) {whole} AND row_number() {by_day}) = 1 AS is_entity_key",
    )
    return seen.agg(
        *[F.expr(f"coalesce(sum({c}), 0L) AS {c}") for c in ("change", "entity", *names)],
        F.expr("coalesce(sum(if(created, 0, change)), 0L) AS early"),
        F.expr("coalesce(sum(if(has_entity, 0, change)), 0L) AS orphan"),
        F.expr("coalesce(sum(if(has_change, 0, entity)), 0L) AS unchanged"),
        F.expr("coalesce(sum(entity), 0L) - count_if(is_entity_key) AS copies"),
    )


def report_of_totals(totals: DataFrame) -> DataFrame:
    """The report from its totals."""
    checked = {CHANGES: "change", ENTITIES: "entity"}
    return _as_report(
        totals,
        [
            *[(r.name, r.table, checked[r.table], r.name) for r in VALIDATION_RULES],
            ("change_not_before_creation", CHANGES, "change", "early"),
            ("change_has_entity", CHANGES, "change", "orphan"),
            ("entity_has_change", ENTITIES, "entity", "unchanged"),
            ("entity_id_unique", ENTITIES, "entity", "copies"),
        ],
    )


def quality_report(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """All validation rules: (rule, table_name, checked, failed, failed_ratio).
    The ratio is over the rows of the rule's own table."""
    return report_of_totals(quality_totals(initial, changes))


def consistency_report(initial: DataFrame, changes: DataFrame, as_of: date) -> DataFrame:
    rules = consistency_rules(as_of)
    return _union(
        [
            row_rule_report(initial, ENTITIES, rules, "entity_id_unique"),
            row_rule_report(changes, CHANGES, rules, "change_id_unique"),
        ]
    )


def flag_changes(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """Every change with one column per rule and ``is_valid``.

    The entity side has one row per id; the changes of a hot licence are cut up.
    """
    known = entity_keys(initial).select("license_id", "creation_date", F.lit(True).alias("_known"))
    flags = {
        "change_not_before_creation": F.coalesce(F.col("date") >= F.col("creation_date"), F.lit(False)),
        "change_has_entity": F.col("_known").isNotNull(),
        **{r.name: r.passed() for r in VALIDATION_RULES if r.table == CHANGES},
    }
    flagged = hot_safe_join(changes, known, ["license_id"], "id").withColumns(flags)
    return _with_is_valid(flagged, list(flags)).select(*changes.columns, *flags, "is_valid")


def flag_entities(initial: DataFrame, changes: DataFrame, position: str) -> DataFrame:
    """Every entity row with one column per rule and ``is_valid``.
    ``position`` tells repeated ids apart: the lowest one is the valid row."""
    changed = changes.select(F.col("license_id").alias("id")).distinct().withColumn("_changed", F.lit(True))
    flags = {
        "entity_has_change": F.col("_changed").isNotNull(),
        **{r.name: r.passed() for r in VALIDATION_RULES if r.table == ENTITIES},
    }
    unique = flag_first_occurrence(initial, "id", position, "entity_id_unique")
    flagged = hot_safe_join(unique, changed, ["id"], position).withColumns(flags)
    names = ["entity_id_unique", *flags]
    return _with_is_valid(flagged, names).select(*initial.columns, *names, "is_valid")


def _with_is_valid(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.withColumn("is_valid", F.forall(F.array(*[F.col(f) for f in flags]), lambda ok: ok))


def early_changes(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """Changes that fail the creation-date rule, with the creation date (NULL for an
    orphan)."""
    known = entity_keys(initial).select("license_id", "creation_date")
    ok = F.coalesce(F.col("date") >= F.col("creation_date"), F.lit(False))
    dated = hot_safe_join(changes, known, ["license_id"], "id")
    return dated.where(~ok).select("id", "license_id", "date", "creation_date")


def orphan_changes(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """Licences that changes refer to but the entity table lacks, with their changes."""
    per_license = changes.groupBy("license_id").agg(F.count("*").alias("n_changes"))
    known = initial.select(F.col("id").alias("license_id")).distinct()
    return per_license.join(known, "license_id", "left_anti")


def unchanged_entities(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """Entity ids that no change refers to."""
    ids = initial.select(F.col("id").alias("license_id")).distinct()
    return ids.join(changes.select("license_id").distinct(), "license_id", "left_anti")


def failing_rows(initial: DataFrame, changes: DataFrame, kind: str) -> DataFrame:
    """Rows of both tables that fail the type or the price rule."""
    test = {"type": is_accepted_type, "price": is_accepted_price}[kind]
    parts = [
        df.where(~test(F.col(kind))).select(F.lit(table).alias("table_name"), "id", kind)
        for df, table in ((changes, CHANGES), (initial, ENTITIES))
    ]
    return parts[0].unionByName(parts[1])


def distribution_checks(initial: DataFrame, approximate: bool = False) -> DataFrame:
    """Fewer customers than licences, and every licence active at creation.
    ``approximate`` counts with sketches, which shuffle no ids."""
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return initial.agg(
        distinct("customer_id").alias("n_customers"),
        distinct("id").alias("n_licenses"),
        F.coalesce(F.bool_and("renewable"), F.lit(True)).alias("all_renewable"),
    ).withColumn("fewer_customers", F.col("n_customers") < F.col("n_licenses"))


def daily_sketches(df: DataFrame, day: str, columns: Sequence[str], log_k: int = SKETCH_LOG_K) -> DataFrame:
    """(day, a sketch per column): what is needed to count distinct values over any days.
    A sketch has at most 2 ** ``log_k`` registers, so a day is a few kilobytes, whatever its rows."""
    return df.groupBy(day).agg(*[F.hll_sketch_agg(c, F.lit(log_k)).alias(c) for c in columns])


def distinct_in_windows(sketches: DataFrame, windows: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """Estimated distinct values of each window (first_day, last_day), from daily sketches alone.

    A window is cut into its days, which are looked up, so neither is compared with all of
    the other.  The error is about 1.04 / sqrt(2 ** log_k), 1.6 % at the default, however many days are merged.
    """
    days = windows.withColumn(day, F.explode(F.sequence("first_day", "last_day")))
    unions = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("long")).alias(c) for c in columns]
    return days.join(sketches, day, "left").groupBy("first_day", "last_day").agg(*unions)


def not_null_report(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """NULL counts of the listed columns of each table, one pass per table."""
    reports = []
    for name, (df, columns) in tables.items():
        totals = df.agg(
            F.count("*").alias("checked"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns]
        )
        reports.append(_as_report(totals, [(f"{c}_not_null", name, "checked", f"n_{c}") for c in columns]))
    return _union(reports)


def accepted_values_report(tables: dict[str, tuple[DataFrame, dict[str, Sequence]]]) -> DataFrame:
    """Rows whose value is not among the accepted ones (or NULL), per listed column of each
    table; one pass per table."""
    reports = []
    for name, (df, accepted) in tables.items():
        totals = df.agg(
            F.count("*").alias("checked"),
            *[F.count_if(~F.coalesce(F.col(c).isin(list(v)), F.lit(False))).alias(f"n_{c}") for c, v in accepted.items()],
        )
        reports.append(_as_report(totals, [(f"{c}_accepted", name, "checked", f"n_{c}") for c in accepted]))
    return _union(reports)


def relationships_report(
    references: Sequence[tuple[str, DataFrame, str, str, DataFrame, str]],
) -> DataFrame:
    """Rows whose value is missing in another table's column, per (name, table, column, other
    name, other table, other column); NULL refers to nothing and passes.

    Rows are counted per value before the join, so a hot value is one row.
    """
    reports = []
    for name, df, column, other_name, other, other_column in references:
        values = df.groupBy(F.col(column).alias("_value")).count()
        known = other.select(F.col(other_column).alias("_value")).distinct().withColumn("_known", F.lit(True))
        joined = values.join(known, "_value", "left")
        unknown = F.col("_value").isNotNull() & F.col("_known").isNull()
        totals = joined.agg(
            F.coalesce(F.sum("count"), F.lit(0)).alias("checked"),
            F.coalesce(F.sum(F.when(unknown, F.col("count"))), F.lit(0)).alias("failed_rows"),
        )
        reports.append(_as_report(totals, [(f"{column}_in_{other_name}", name, "checked", "failed_rows")]))
    return _union(reports)


def mart_invariants(mart: DataFrame, initial: DataFrame, changes: DataFrame) -> DataFrame:
    """One verdict row per invariant of the daily metrics: its exact columns, no negative level,
    the list price, and a last-day total equal to the number of licences."""
    bounds = calendar_bounds(initial, changes)
    conserved = mart_conservation(mart, initial, bounds)
    last = conserved.orderBy(F.col("date").desc()).limit(1)
    checked = price_by_type_check(mart)
    columns = F.lit(sorted(mart.columns) == sorted(MART_COLUMNS))
    verdicts = [
        mart.limit(1).agg(columns.alias("holds")).select(F.lit("columns").alias("invariant"), "holds"),
        checked.agg(F.coalesce(F.bool_and("is_non_negative"), F.lit(True)).alias("holds")).select(
            F.lit("non_negative").alias("invariant"), "holds"
        ),
        checked.agg(F.coalesce(F.bool_and("is_consistent"), F.lit(True)).alias("holds")).select(
            F.lit("list_price").alias("invariant"), "holds"
        ),
        last.agg(
            F.coalesce(F.bool_and(F.col("total_licenses") == F.col("existing_licenses")), F.lit(True)).alias("holds")
        ).select(F.lit("last_day_total").alias("invariant"), "holds"),
    ]
    return _union(verdicts)


def panel_quality(intervals: DataFrame, bounds: DataFrame) -> DataFrame:
    """Daily-panel rules: key columns not NULL and ``renewable`` true or false.

    An interval stands for its days, so days are counted and not generated.
    """
    weighed = with_bounds(intervals, bounds).selectExpr(
        "*", "datediff(coalesce(valid_to, date_add(span.last_day, 1)), valid_from) AS days"
    )
    totals = weighed.agg(
        F.expr("sum(days) AS checked"),
        F.expr("sum(if(license_id IS NULL, days, 0)) AS no_license"),
        F.expr("sum(if(valid_from IS NULL, days, 0)) AS no_date"),
        F.expr("sum(if(coalesce(renewable IN (true, false), false), 0, days)) AS no_flag"),
    )
    return _as_report(
        totals,
        [
            ("license_id_not_null", "daily_states", "checked", "no_license"),
            ("date_not_null", "daily_states", "checked", "no_date"),
            ("renewable_accepted", "daily_states", "checked", "no_flag"),
        ],
    )


def price_by_type_check(mart: DataFrame) -> DataFrame:
    """Does each active price equal active count x unit price of the type?"""
    expected = F.col("active_license_count") * unit_price(F.col("type"))
    return mart.select(
        "date",
        "type",
        "active_license_price",
        expected.alias("expected_price"),
        F.coalesce(F.col("active_license_price") == expected, F.lit(False)).alias("is_consistent"),
        (
            (F.col("active_license_count") >= 0)
            & (F.col("inactive_license_count") >= 0)
            & (F.col("active_license_price") >= 0)
        ).alias("is_non_negative"),
    )


def mart_conservation(mart: DataFrame, initial: DataFrame, bounds: DataFrame) -> DataFrame:
    """Licences in the metrics per day beside the licences created until then.

    The running count goes over one row per calendar day.
    """
    totals = mart.groupBy("date").agg(
        F.sum(F.col("active_license_count") + F.col("inactive_license_count")).alias("total_licenses")
    )
    created = entity_keys(initial).groupBy(F.col("creation_date").alias("date")).agg(F.count("*").alias("created"))
    days = densify(created.withColumn("axis", F.lit("all")), ["axis"], bounds, {"created": 0})
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = days.select("date", F.sum("created").over(so_far).alias("existing_licenses"))
    return totals.join(expected, "date", "left")
