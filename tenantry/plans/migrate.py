"""Moving one tenant: extract, anonymize, validate, decide, load, report."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.model import BusinessRule, ForeignKey, RelationRule, RequiredFields, SchemaRule, StoreRule, Tables
from tenantry.operators import validate
from tenantry.operators.anonymize import Anonymizer, matched_columns, remember, suspicious_values
from tenantry.operators.extract import extract_dataset, table_order
from tenantry.operators.load import Target, load_dataset
from tenantry.operators.reconcile import compare_checksums, compare_counts, compare_fan_out
from tenantry.operators.report import METRICS_SCHEMA
from tenantry.state import new_folder, save


@dataclass(frozen=True)
class Plan:
    """What to move and under which rules."""

    keys: Sequence[ForeignKey]
    primary_keys: Mapping[str, Sequence[str]]
    where: Mapping[str, object]
    anonymizer: Anonymizer
    tenant_columns: Mapping[str, Mapping[str, object]] = field(default_factory=dict)
    broken: Sequence[ForeignKey] = ()
    rules: Sequence[BusinessRule] = ()
    required: Sequence[RequiredFields] = ()
    strategy: str = "insert"
    custom: validate.CustomChecks | None = None
    fail_on_warnings: bool = False
    max_warnings: int | None = None
    schemas: Sequence[SchemaRule] = ()
    relations: Sequence[RelationRule] = ()
    stores: Sequence[StoreRule] = ()
    #: Load although the decision is REVIEW.
    reviewed: bool = False

    def checks(self) -> dict:
        """What ``validate_dataset`` takes of this plan."""
        return {
            "keys": [k for k in self.keys if k not in self.broken],
            "primary_keys": self.primary_keys,
            "rules": self.rules,
            "required": self.required,
            "as_of": self.anonymizer.as_of,
            "custom": self.custom,
            "schemas": self.schemas,
            "relations": self.relations,
            "stores": self.stores,
        }


@dataclass
class Result:
    tables: Tables
    findings: DataFrame | None
    outcome: dict
    metrics: DataFrame


class _Log:
    """Metrics of a run; a few rows for each phase and table."""

    def __init__(self, spark: SparkSession, run_id: str, tenant: str) -> None:
        self.spark, self.run_id, self.tenant = spark, run_id, tenant
        self.rows: list[tuple] = []

    def add(self, phase, table, rows, seconds, *, fields=0, success=True, warnings=0, message=None) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        store = table.split("_", 1)[0] if table else None
        self.rows.append(
            (self.run_id, self.tenant, phase, store, table, rows, fields, success, warnings, float(seconds), now, message)
        )

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, METRICS_SCHEMA)


def _count(df: DataFrame) -> int:
    return df.count()  # the table was just written: answered from Parquet footers


def migrate_tenant(
    source: Tables,
    plan: Plan,
    target: Target,
    *,
    extracted: Tables | None = None,
    skip_load: bool = False,
    dry_run: bool = False,
    validation_only: bool = False,
    work_folder: str | None = None,
    maps: Target | None = None,
) -> Result:
    """Move a tenant; nothing reaches the target unless validation lets it.

    Every phase writes its tables once, and the next phase reads them; the work
    folder is also where a run can be taken up again, by passing ``extracted``.
    Warnings that call for a review stop the load until the plan is ``reviewed``.
    ``dry_run`` does everything but load; ``validation_only`` validates the given
    ``extracted`` tables as they are.  With ``maps`` every value gets what earlier
    runs gave it, and the map of all surrogates and tokens is kept there.
    """
    spark = target.spark
    run_id = uuid.uuid4().hex
    folder = work_folder or new_folder(spark, "run")
    log = _Log(spark, run_id, ",".join(str(v) for v in plan.where.values()) or "all")

    def timed_save(phase: str):
        def keep(name: str, df: DataFrame) -> DataFrame:
            begin = time.monotonic()
            written = save(df, f"{folder}/{phase}/{name}.parquet")
            fields = len(matched_columns(df, plan.anonymizer.rules)) if phase == "anonymization" else 0
            log.add(phase, name, _count(written), time.monotonic() - begin, fields=fields)
            return written

        return keep

    if extracted is None:
        extracted = extract_dataset(
            source,
            plan.keys,
            plan.where,
            tenant_columns=plan.tenant_columns,
            broken=plan.broken,
            save=timed_save("extraction"),
        )
    if validation_only:
        data = extracted
    else:
        keep = timed_save("anonymization")
        ready = plan.anonymizer if maps is None else remember(maps, extracted, plan.anonymizer, run_id, keep=not dry_run)
        data = {name: keep(name, df) for name, df in ready.dataset(extracted).items()}
        leaks = [suspicious_values(df, plan.anonymizer.rules) for df in data.values()]
        found = validate.union_all(leaks).filter("suspicious > 0").agg(F.count(F.lit(1)).alias("n")).first().n
        if found:
            log.add("anonymization", None, 0, 0.0, success=False, message=f"{found} columns look like personal data")
            return Result(data, None, {"overall_status": "FAILED", "decision": "STOP"}, log.frame())

    begin = time.monotonic()
    findings = save(
        validate.validate_dataset(data, **plan.checks()),
        f"{folder}/findings.parquet",
    )
    outcome = (
        validate.outcome(findings, fail_on_warnings=plan.fail_on_warnings, max_warnings=plan.max_warnings).first().asDict()
    )
    passed = outcome["overall_status"] != "FAILED"
    message = None if passed else f"Validation failed: {outcome['total_failed']} checks failed"
    if passed and outcome["decision"] == "REVIEW" and not plan.reviewed:
        message = f"{outcome['total_warnings']} warnings have to be reviewed before the load"
    log.add(
        "validation",
        None,
        outcome["total_checks"],
        time.monotonic() - begin,
        success=passed,
        warnings=outcome["total_warnings"],
        message=message,
    )
    waits = outcome["decision"] == "REVIEW" and not plan.reviewed
    if passed and not (waits or skip_load or dry_run or validation_only):
        begin = time.monotonic()
        order = table_order(list(data), plan.keys, plan.broken)
        loaded = load_dataset(target, data, plan.primary_keys, plan.strategy, order=order, note=run_id)
        seconds = time.monotonic() - begin
        for name in loaded:
            log.add("loading", name, _count(data[name]), seconds / len(loaded))
    return Result(data, findings, outcome, log.frame())


def validate_migration(expected: Tables, target: Tables, plan: Plan) -> dict[str, DataFrame]:
    """All checks on what was loaded, and its comparison with what should have been."""
    shared = [k for k in plan.keys if k.child in expected and k.child in target]
    return {
        "findings": validate.validate_dataset(target, **plan.checks()),
        "counts": compare_counts(expected, target),
        "checksums": compare_checksums(expected, target),
        "fan_out": compare_fan_out(expected, target, shared),
    }
