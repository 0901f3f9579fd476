"""From the JSON of a drop to typed Parquet, one load date at a time.

A source is read once to learn its schema and once to be written; the second pass also
counts what spoils a load: malformed records, and text that is no date in a date column.
Rows are written aside and only become the load when those counts are zero, so a spoilt
source changes neither the load before it nor the contract.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.operators.together import together
from galley.operators.upsert import upsert
from galley.sources.contracts import CONTRACTS, ENTITIES
from galley.sources.entity_json import (
    MALFORMED,
    accepted_schema,
    date_columns,
    drift_rows,
    is_bad_date,
    observe_schema,
    read_json,
    timestamp_columns,
    typed,
    with_lineage,
    with_malformed,
)
from galley.sources.store import TableStore

SUCCESS, HALTED, ERROR = "success", "halted_schema_drift", "error"


@dataclass
class SourceReport:
    """What became of one source. ``accepted`` is the contract it asks for, if it changed."""

    source: str
    path: str
    status: str = ERROR
    drift: list = field(default_factory=list)
    timestamp_nulls: dict[str, int] = field(default_factory=dict)
    malformed_records: int = 0
    error: str | None = None
    accepted: T.StructType | None = None

    COLUMNS: ClassVar[str] = (
        "source string, path string, status string, drift array<struct<source: string, column: string, "
        "change: string, expected: string, actual: string, breaking: boolean>>, "
        "timestamp_nulls map<string, bigint>, malformed_records bigint, error string"
    )

    def row(self) -> tuple:
        return (
            self.source, self.path, self.status, self.drift, self.timestamp_nulls, self.malformed_records, self.error
        )


class ConversionFailed(RuntimeError):
    def __init__(self, failures: list[tuple[str, str]]):
        named = ", ".join(f"{source} ({status})" for source, status in failures)
        super().__init__(f"not converted: {named}")
        self.failures = failures


def load_contracts(store: TableStore) -> dict[str, T.StructType]:
    """The contracts in force: those shipped, replaced by those accepted since."""
    accepted = store.latest("state", "contracts")
    rows = accepted.collect() if accepted is not None else []  # one row per entity
    return CONTRACTS | {r["source"]: T.StructType.fromJson(json.loads(r["columns"])) for r in rows}


def accept_contracts(store: TableStore, schemas: Mapping[str, T.StructType]) -> None:
    """Make observed schemas the contracts of the next loads."""
    columns = "source string, columns string"
    changes = store.spark.createDataFrame([(s, schema.json()) for s, schema in schemas.items()], columns)
    before = store.latest("state", "contracts")
    if before is None:
        before = store.spark.createDataFrame([], columns)
    store.advance("state", "contracts", upsert(before, changes, "source", ["columns"]))


def convert_source(
    store: TableStore,
    source: str,
    path: str,
    contract: T.StructType,
    load_date: str,
    batch_id: str,
    arrays: bool = True,
) -> SourceReport:
    """Check one source against its contract and write its Parquet of the load date."""
    report, aside = SourceReport(source, path), None
    try:
        observed = observe_schema(store.spark, path, arrays)
        report.drift = drift_rows(source, contract, observed)
        if any(breaking for *_, breaking in report.drift):
            report.status = HALTED
            return report
        wanted = accepted_schema(contract, observed)
        dates, stamps = date_columns(wanted), timestamp_columns(source)
        seen = Observation()
        rows = read_json(store.spark, path, with_malformed(observed), arrays).observe(
            seen,
            F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"),
            *[F.count_if(is_bad_date(c)).alias(f"date {c}") for c in dates],
            *[F.count_if(F.col(c).try_cast("timestamp_ntz").isNull()).alias(f"time {c}") for c in stamps],
        )
        aside = store.attempt("typed", source, with_lineage(typed(rows, wanted), source, batch_id))
        counts = seen.get
        report.malformed_records = counts["malformed"]
        report.timestamp_nulls = {c: counts[f"time {c}"] for c in stamps if counts[f"time {c}"]}
        report.drift += [(source, c, "type", "date", "string", True) for c in dates if counts[f"date {c}"]]
        if report.malformed_records:
            report.error = f"{report.malformed_records} malformed record(s) in {path}"
        elif any(counts[f"date {c}"] for c in dates):
            report.status = HALTED
        else:
            store.keep_load(source, aside, load_date)
            report.status, report.accepted = SUCCESS, wanted if report.drift else None
    except (PySparkException, OSError) as problem:
        report.status, report.error = ERROR, str(problem)
    finally:
        if aside is not None and report.status != SUCCESS:
            store.discard(aside)
    return report


def convert_drop(
    store: TableStore,
    paths: Mapping[str, str],
    load_date: str,
    batch_id: str,
    arrays: bool = True,
) -> DataFrame:
    """Convert the sources of a drop side by side, write the manifest, then report failures.

    ``paths`` maps entities to their JSON. One that fails does not keep the others back.
    """
    if not paths or set(paths) - set(ENTITIES):
        raise ValueError(f"sources have to be some of {ENTITIES}, not {tuple(paths)}")
    contracts = load_contracts(store)
    reports = list(
        together(
            {
                s: lambda s=s, path=path: convert_source(store, s, path, contracts[s], load_date, batch_id, arrays)
                for s, path in paths.items()
            }
        ).values()
    )
    changed = {r.source: r.accepted for r in reports if r.accepted is not None}
    if changed:
        accept_contracts(store, changed)
    failures = [(r.source, r.status) for r in reports if r.status != SUCCESS]
    manifest = store.spark.createDataFrame([r.row() for r in reports], SourceReport.COLUMNS).withColumns(
        {
            "execution_date": F.lit(load_date),
            "batch_id": F.lit(batch_id),
            "run_status": F.lit("partial_failure" if failures else "success"),
            "run_completed_at": F.current_timestamp(),
        }
    )
    store.write_partition("typed", "manifest", manifest, "load_date", load_date)
    if failures:
        raise ConversionFailed(failures)
    return conversion_manifest(store, load_date)


def conversion_manifest(store: TableStore, load_date: str) -> DataFrame:
    """The manifest of the last conversion of a date."""
    rows = store.read_all("typed", "manifest", "load_date")
    return rows.where(F.col("load_date") == load_date).drop("load_date")
