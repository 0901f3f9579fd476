"""Data-quality results and row-level exceptions.

Rules are data: a SQL predicate per check. Each table is tagged once with what the rules
need from other tables, and all its rules are evaluated in that one pass; results count
the rows that fail, exceptions list them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from galley.operators.durable import pin
from galley.operators.joins import lookup, mark_known
from galley.operators.together import together
from galley.plans.quality_texts import CHECKS, RULEBOOK
from galley.sources.contracts import CHANNELS, DELIVERED_CHANNELS

Rules = Mapping[str, str]


@dataclass(frozen=True)
class AuditRun:
    """What identifies an audit run, and the dates its rules are relative to."""

    run_id: str
    execution_date: dt.date
    today: dt.date
    earliest_order: dt.date = dt.date(2020, 1, 1)
    late_window_days: int = 30


def manual_run(execution_date: dt.date, **options) -> AuditRun:
    return AuditRun(f"manual-{execution_date}", execution_date, execution_date, **options)


def _listed(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# rules per table: SQL predicates that hold for the rows at fault -----------------------


def order_rules(run: AuditRun) -> Rules:
    """Over orders tagged by ``tag_orders``."""
    day = "CAST(order_timestamp AS DATE)"
    return {
        "orphan_order_customer": "NOT _has_customer",
        "orphan_order_store": "NOT _has_store",
        "null_critical_order_fields": (
            "order_id IS NULL OR customer_id IS NULL OR store_id IS NULL OR order_timestamp IS NULL"
        ),
        "negative_order_amount": "subtotal_ngn < 0 OR total_amount_ngn < 0",
        "invalid_channel": f"channel IS NULL OR channel NOT IN ({_listed(CHANNELS)})",
        "missing_delivery_for_delivery_order": (
            f"channel IN ({_listed(DELIVERED_CHANNELS)}) AND NOT _has_delivery"
        ),
        "invalid_order_timestamp": (
            f"order_timestamp IS NULL OR {day} < DATE '{run.earliest_order}'"
            f" OR {day} > date_add(DATE '{run.today}', 1)"
        ),
        "discount_exceeds_subtotal": "discount_ngn > subtotal_ngn",
        "order_total_formula_mismatch": (
            "abs(subtotal_ngn - discount_ngn + tax_ngn + delivery_fee_ngn - total_amount_ngn) > 0.05"
        ),
        "order_items_count_mismatch": "_lines <> items_count",
        "order_quantity_total_mismatch": "_units <> qty_total",
        "promo_with_zero_discount": "promo_code <> '' AND discount_ngn = 0",
        "late_arriving_order_records": (
            f"CAST(_loaded_at AS DATE) > date_add({day}, 1)"
            f" AND {day} >= date_sub(DATE '{run.today}', {run.late_window_days})"
        ),
        "order_item_subtotal_mismatch": "abs(_line_revenue - subtotal_ngn) > 0.01",
    }


ITEM_RULES: Rules = {
    "orphan_item_order": "NOT _has_order",
    "orphan_item_product": "NOT _has_product",
    "negative_item_revenue": "product_revenue < 0 OR quantity <= 0",
}

DELIVERY_RULES: Rules = {
    "orphan_delivery_order": "NOT _has_order",
    "invalid_delivery_sla_flag": "delivery_sla_met_flag IS NULL OR delivery_sla_met_flag NOT IN (0, 1)",
    "invalid_delivery_time": (
        "promised_delivery_minutes IS NULL OR promised_delivery_minutes <= 0"
        " OR actual_delivery_minutes IS NULL OR actual_delivery_minutes <= 0"
    ),
}

FACT_ORDER_RULES: Rules = {
    "missing_fact_store_mapping": "store_sk IS NULL",
    "fact_orders_null_foreign_key": (
        "customer_sk IS NULL OR store_sk IS NULL OR channel_sk IS NULL"
        " OR payment_method_sk IS NULL OR promo_sk IS NULL OR date_sk IS NULL"
    ),
}

FACT_ITEM_RULES: Rules = {
    "missing_fact_product_mapping": "product_sk IS NULL",
    "fact_order_items_null_foreign_key": (
        "product_sk IS NULL OR store_sk IS NULL OR channel_sk IS NULL OR date_sk IS NULL"
    ),
}

FACT_DELIVERY_RULES: Rules = {
    "fact_deliveries_null_foreign_key": "store_sk IS NULL OR date_sk IS NULL",
}

# Exceptions of these checks name no source file.
_NO_LINEAGE = ("missing_fact_store_mapping", "missing_fact_product_mapping")


# tagging -----------------------------------------------------------------------------


def tag_orders(
    orders: DataFrame, customers: DataFrame, stores: DataFrame, deliveries: DataFrame, items: DataFrame
) -> DataFrame:
    """Orders with the presence of their parents and the totals of their lines."""
    lines = items.groupBy(F.col("order_id").alias("_order")).agg(
        F.count("*").alias("_lines"),
        F.sum("quantity").alias("_units"),
        F.sum("product_revenue").alias("_line_revenue"),
    )
    tagged = mark_known(orders, stores, ["store_id"], "_has_store")
    tagged = mark_known(tagged, customers, ["customer_id"], "_has_customer", hot_from=orders)
    # both sides hold an order once, so these two joins share one partitioning
    known = deliveries.select(F.col("order_id").alias("_delivered")).distinct()
    tagged = tagged.join(lines, F.col("order_id") == F.col("_order"), "left")
    tagged = tagged.join(known, F.col("order_id") == F.col("_delivered"), "left")
    return tagged.withColumn("_has_delivery", F.col("_delivered").isNotNull()).drop(
        "_order", "_delivered"
    )


def tag_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    tagged = mark_known(items, products, ["product_id"], "_has_product")
    return mark_known(tagged, orders, ["order_id"], "_has_order", hot_from=items)


def tag_deliveries(deliveries: DataFrame, orders: DataFrame) -> DataFrame:
    return mark_known(deliveries, orders, ["order_id"], "_has_order")


# measuring ---------------------------------------------------------------------------


def daily_jumps(orders: DataFrame) -> DataFrame:
    """Days whose order count moved by more than half against the day before.

    ``lag`` runs over one row per calendar day.
    """
    daily = orders.groupBy(F.col("order_timestamp").cast("date").alias("order_date")).agg(
        F.count("*").alias("order_count")
    )
    before = F.lag("order_count").over(W.orderBy(F.col("order_date").asc_nulls_last()))
    change = F.abs(F.col("order_count") - F.col("previous_order_count"))
    return daily.withColumn("previous_order_count", before).where(
        (F.col("previous_order_count") >= 10) & (change * 2 > F.col("previous_order_count"))
    )


def failing_rows(df: DataFrame, rules: Rules, key: str) -> DataFrame:
    """One row per failing row and rule."""
    cases = ", ".join(f"IF({fails}, '{name}', NULL)" for name, fails in rules.items())
    named = f"check_name NOT IN ({_listed(_NO_LINEAGE)})"
    return df.selectExpr(
        f"explode(array_compact(array({cases}))) AS check_name",
        f"{key} AS record_key",
        "_source_file",
        "_loaded_at",
    ).selectExpr(
        "check_name",
        "record_key",
        f"IF({named}, _source_file, NULL) AS source_file",
        f"IF({named}, _loaded_at, NULL) AS loaded_at",
    )


def repeated_keys(keyed: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per check and key that occurs more than once or has a NULL; keys have one or two columns.

    Rows are first counted by a hash of their key, for all tables in one aggregation and
    before the shuffle. Text and lineage are then taken only of rows whose hash occurs more
    than once or stands for a NULL, so the texts of unique keys are not shuffled or sorted.
    """
    lineage = {"_source_file": "STRING", "_loaded_at": "TIMESTAMP_NTZ"}
    rows = []
    for name, (df, keys) in keyed.items():
        known = [c if c in df.columns else f"CAST(NULL AS {kind}) AS {c}" for c, kind in lineage.items()]
        second = f"CAST({keys[1]} AS STRING)" if len(keys) > 1 else "CAST(NULL AS STRING)"
        first = f"CAST({keys[0]} AS STRING)"
        rows.append(
            df.selectExpr(f"'{name}' AS check_name", f"{first} AS key_1", f"{second} AS key_2", f"{len(keys)} AS parts", *known)
        )
    has_null = F.expr("key_1 IS NULL OR (parts = 2 AND key_2 IS NULL)")
    hashed = reduce(DataFrame.union, rows).withColumn("_hash", F.xxhash64("check_name", "key_1", "key_2"))
    counted = hashed.groupBy("_hash").agg(F.count("*").alias("n"), F.max(has_null).alias("has_null"))
    suspects = pin(counted.where("n > 1 OR has_null").select("_hash"))
    per_key = lookup(hashed, suspects, ["_hash"], "left_semi").groupBy("check_name", "key_1", "key_2", "parts").agg(
        F.count("*").alias("n"),
        F.min("_source_file").alias("source_file"),
        F.max("_loaded_at").alias("loaded_at"),
    )
    return per_key.withColumn("has_null", has_null).where("n > 1 OR has_null")


# rows minus distinct keys: a NULL key is a duplicate by itself, but among order items it is a value
DUPLICATES = "sum(n - IF(has_null AND check_name <> 'duplicate_order_item_key', 0, 1))"


# the audit ---------------------------------------------------------------------------


class QualityAudit:
    """All checks over the staged tables and marts of one warehouse."""

    def __init__(self, tables: Mapping[str, DataFrame], run: AuditRun):
        self.t = tables
        self.run = run
        self.spark: SparkSession = next(iter(tables.values())).sparkSession

    @cached_property
    def orders(self) -> DataFrame:
        t = self.t
        return tag_orders(
            t["int_orders"], t["int_customers"], t["int_stores"], t["int_deliveries"], t["int_order_items"]
        )

    @cached_property
    def items(self) -> DataFrame:
        return tag_items(self.t["int_order_items"], self.t["int_orders"], self.t["int_products"])

    @cached_property
    def deliveries(self) -> DataFrame:
        return tag_deliveries(self.t["int_deliveries"], self.t["int_orders"])

    def _row_checks(self) -> list[tuple[DataFrame, Rules, str]]:
        t, line = self.t, "order_id || '|' || product_id"
        return [
            (self.orders, order_rules(self.run), "order_id"),
            (self.items, ITEM_RULES, line),
            (self.deliveries, DELIVERY_RULES, "order_id"),
            (t["fact_orders"], FACT_ORDER_RULES, "order_id"),
            (t["fact_order_items"], FACT_ITEM_RULES, line),
            (t["fact_deliveries"], FACT_DELIVERY_RULES, "order_id"),
        ]

    @cached_property
    def failing(self) -> DataFrame:
        """Check, key and lineage of every failing row, written once for results and exceptions.

        Tables are tagged for this alone, so each is read and joined once in an audit.
        """
        return pin(reduce(DataFrame.unionByName, [failing_rows(df, rules, key) for df, rules, key in self._row_checks()]))

    @cached_property
    def repeated(self) -> DataFrame:
        """Keys that duplicate checks are about, written once."""
        t, pair = self.t, ["order_id", "product_id"]
        keyed = {
            "duplicate_customer_id": (t["int_customers"], ["customer_id"]),
            "duplicate_store_id": (t["int_stores"], ["store_id"]),
            "duplicate_product_id": (t["int_products"], ["product_id"]),
            "duplicate_order_id": (t["int_orders"], ["order_id"]),
            "duplicate_order_item_key": (t["int_order_items"], pair),
            "duplicate_dim_customer_sk": (t["dim_customer"], ["customer_sk"]),
            "duplicate_dim_product_sk": (t["dim_product"], ["product_sk"]),
            "duplicate_dim_store_current_row": (t["dim_store"].where("is_current"), ["store_id"]),
            "duplicate_fact_order_item_grain": (t["fact_order_items"], pair),
        }
        return pin(repeated_keys(keyed))

    def prepare(self) -> None:
        """Make what results and exceptions share, before they are asked for side by side."""
        together({"failing": lambda: self.failing, "repeated": lambda: self.repeated})

    def observed(self) -> DataFrame:
        """``check_name, observed_value`` of the checks; checks without a finding may be absent."""
        t = self.t
        totals = [
            t[f"int_{entity}"].agg(F.count("*").alias("observed_value")).select(
                F.lit(f"{entity}_record_count").alias("check_name"), "observed_value"
            )
            for entity in ("customers", "stores", "products", "orders", "order_items", "deliveries")
        ]
        found = self.failing.groupBy("check_name").agg(F.count("*").alias("observed_value"))
        repeated = self.repeated.groupBy("check_name").agg(F.expr(f"{DUPLICATES} AS observed_value"))
        jumps = daily_jumps(t["int_orders"]).agg(F.count("*").alias("observed_value")).select(
            F.lit("unusual_daily_order_volume_change").alias("check_name"), "observed_value"
        )
        return reduce(DataFrame.unionByName, [*totals, found, repeated, jumps])

    def results(self) -> DataFrame:
        """One row per check with its status."""
        known = self.spark.createDataFrame(
            [(c.name, c.severity, c.minimum) for c in CHECKS],
            "check_name string, severity string, expected_minimum int",
        )
        status = """CASE
            WHEN check_name LIKE '%record_count' THEN IF(observed_value < expected_minimum, 'FAIL', 'PASS')
            WHEN observed_value <= expected_minimum THEN 'PASS'
            WHEN severity = 'WARN' THEN 'WARN' ELSE 'FAIL' END"""
        # the checks are 41 rows, and so is what was observed
        seen = F.broadcast(self.observed().groupBy("check_name").agg(F.max("observed_value").alias("seen")))
        found = known.join(seen, "check_name", "left").withColumn(
            "observed_value", F.coalesce("seen", F.lit(0))
        )
        return found.select(
            F.lit(self.run.run_id).alias("run_id"),
            F.lit(self.run.execution_date).alias("execution_date"),
            F.current_timestamp().alias("checked_at"),
            "check_name",
            "severity",
            "observed_value",
            "expected_minimum",
            F.expr(status).alias("status"),
        )

    def exceptions(self) -> DataFrame:
        """The rows behind the checks that can name them."""
        t = self.t
        listed = [c for c in CHECKS if c.issue]
        named = ("duplicate_order_id", "duplicate_order_item_key", "duplicate_fact_order_item_grain")
        parts = [
            self.failing,
            self.repeated.where(F.col("check_name").isin(*named) & (F.col("n") > 1)).selectExpr(
                "check_name", "IF(parts = 1, key_1, key_1 || '|' || key_2) AS record_key", "source_file", "loaded_at"
            ),
            daily_jumps(t["int_orders"]).select(
                F.lit("unusual_daily_order_volume_change").alias("check_name"),
                F.col("order_date").cast("string").alias("record_key"),
                F.lit(None).cast("string").alias("source_file"),
                F.lit(None).cast(t["int_orders"].schema["_loaded_at"].dataType).alias("loaded_at"),
            ),
        ]
        texts = self.spark.createDataFrame(
            [(c.name, c.severity, c.source_table, c.issue, c.action) for c in listed],
            "check_name string, severity string, source_table string, issue string, recommended_action string",
        )
        return reduce(DataFrame.unionByName, parts).join(F.broadcast(texts), "check_name").select(
            F.lit(self.run.run_id).alias("run_id"),
            F.lit(self.run.execution_date).alias("execution_date"),
            F.current_timestamp().alias("detected_at"),
            "check_name",
            "severity",
            "source_table",
            "record_key",
            "issue",
            "recommended_action",
            "source_file",
            "loaded_at",
        )


def rulebook(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(RULEBOOK), "severity string, handling_action string, handling_notes string"
    )


def exception_summary(exceptions: DataFrame) -> DataFrame:
    """Exceptions per check, with the first and last time they were seen."""
    return exceptions.groupBy("check_name", "severity", "source_table").agg(
        F.count("*").alias("exception_count"),
        F.min("detected_at").alias("first_detected_at"),
        F.max("detected_at").alias("last_detected_at"),
    )


class AuditFailed(RuntimeError):
    """``blockers`` are the rows of `blocking` that stopped the run."""

    def __init__(self, blockers: Sequence[Row]):
        named = ", ".join(f"{b['name']} ({b['kind']}, {b['failures']})" for b in blockers)
        super().__init__(f"stopped by {named}")
        self.blockers = list(blockers)


def blocking(results: DataFrame, reconciliation: DataFrame, exceptions: DataFrame) -> DataFrame:
    """``kind, name, failures``: every failed check and metric, and exceptions that are errors.

    Warnings never block.
    """
    failed, error = F.col("status") == "FAIL", F.col("severity") == "ERROR"
    kinds = {
        "check": results.where(failed).select(F.col("check_name").alias("name")),
        "metric": reconciliation.where(failed).select(F.col("metric").alias("name")),
        "exception": exceptions.where(error).select(F.col("check_name").alias("name")),
    }
    tagged = [rows.select(F.lit(kind).alias("kind"), "name") for kind, rows in kinds.items()]
    return reduce(DataFrame.union, tagged).groupBy("kind", "name").agg(F.count("*").alias("failures"))


def require_passed(results: DataFrame, reconciliation: DataFrame, exceptions: DataFrame) -> None:
    """Raise `AuditFailed` if anything blocks; a row per check or metric comes to the driver."""
    if found := blocking(results, reconciliation, exceptions).orderBy("kind", "name").collect():
        raise AuditFailed(found)
