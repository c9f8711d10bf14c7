"""Runs the rules over the raw tables and keeps results and failing keys per run.

All row checks of a table share one scan, and all rules on keys one aggregation; only the failing
keys flow on, and they are written by the executors. Counts per rule come from the failing keys. The driver sees the per-rule results
only (39 rows).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medledger.functions import ratio
from medledger.functions.scalars import MONEY, SHARE
from medledger.operators.duplicates import surplus_claims
from medledger.operators.staging import with_parsed
from medledger.quality.rules import RECORD_KEY, RULES, WEIGHT, FirstOnly, KnownParent, RowCheck, Rule, UniqueKey
from medledger.sources import commits
from medledger.sources.lake import Lake
from medledger.sources.landing import count_rows, union_all
from medledger.sources.schemas import NUMBER_COLUMNS

RESULT_COLUMNS = ["run_id", "run_ts", "rule_id", "rule_name", "dimension", "severity", "table_name", "column_name",
                  "rows_checked", "rows_failed", "fail_rate", "threshold", "passed"]
RECORD_COLUMNS = ["run_id", "rule_id", "table_name", "record_key", "captured_at"]


class QualityGateError(RuntimeError):
    """A critical rule failed."""

    exit_code = 2

    def __init__(self, rule_ids: list[str]):
        super().__init__(f"critical data-quality failures ({len(rule_ids)}): {', '.join(rule_ids)}")
        self.rule_ids = rule_ids


def _row_failures(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Rule ids of every failing row, from one scan.

    The ids of failed checks are joined to one text (``concat_ws`` skips the NULL of a passed one)
    and split again, all inside generated code. ``explode_outer`` rather than a filter on the text:
    a filter would be pushed below the parsed columns and parse each value again in every check.
    """
    failed = F.concat_ws(",", *[F.when(r.check.fails(), F.lit(r.id)) for r in rules])
    hit = with_parsed(table, df).select(F.col(RECORD_KEY[table]).alias("record_key"), failed.alias("failed"))
    ids = F.when(F.col("failed") != "", F.split("failed", ","))
    return hit.select(F.explode_outer(ids).alias("rule_id"), "record_key").filter(F.col("rule_id").isNotNull())


def _surplus(raw: dict[str, DataFrame], r: Rule) -> DataFrame:
    return surplus_claims(raw[r.table]).select(F.lit(r.id).alias("rule_id"), "record_key")


def _exploded(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


#: Puts an intermediate result away and reads it again, by which Spark knows its size.
Keep = Callable[[DataFrame], DataFrame]


def _key_failures(raw: Mapping[str, DataFrame], rules: list[Rule], keep: Keep) -> DataFrame:
    """(rule_id, table_name, record_key) of all rules on keys, from one aggregation.

    A key space is a parent's key, or a unique column. Each row gives its keys, tagged with their space and whether it
    owns the key or refers to it, in one scan of its table. Folded by (space, key), with counts added up before the
    shuffle, a key owned more than once is a repeated one, and one that no row owns is lost. These are put away by ``keep``.
    The rows that refer to lost keys are then found by an equality join on these, for which Spark shuffles no row if they
    are few; a hot key is one row until there.
    """
    def space(table: str, column: str) -> str:
        return f"{table}.{column}"

    reads: dict[str, set[tuple[str, str, bool]]] = {}
    for r in rules:
        if isinstance(r.check, UniqueKey):
            reads.setdefault(r.table, set()).add((r.check.key, space(r.table, r.check.key), True))
        else:
            of = space(r.check.parent, r.check.parent_key)
            reads.setdefault(r.check.parent, set()).add((r.check.parent_key, of, True))
            reads.setdefault(r.table, set()).add((r.check.key, of, False))
    tagged = union_all([
        _exploded(raw[t], [F.struct(F.lit(of).alias("space"), F.col(c).alias("key"), F.lit(owns).alias("owns")) for c, of, owns in sorted(found)])
        for t, found in sorted(reads.items())])
    per_key = tagged.groupBy("space", "key").agg(F.count_if("owns").alias("owners"), F.count_if(~F.col("owns")).alias("children"))
    # a missing key is a parent of none
    is_lost = "children > 0 AND (owners = 0 OR key IS NULL)"
    per_key = keep(per_key.filter(f"({is_lost}) OR owners > 1"))
    lost = per_key.filter(is_lost).select(F.col("space").alias("_space"), F.col("key").alias("_key"))
    parts = []
    unique = [r for r in rules if isinstance(r.check, UniqueKey)]
    if unique:
        rule_of = F.create_map(*[F.lit(x) for r in unique for x in (space(r.table, r.check.key), r.id)])
        table_of = F.create_map(*[F.lit(x) for r in unique for x in (space(r.table, r.check.key), r.table)])
        repeated = per_key.filter(F.col("space").isin(*[space(r.table, r.check.key) for r in unique]) & (F.col("owners") > 1))
        parts.append(repeated.select(rule_of[F.col("space")].alias("rule_id"), table_of[F.col("space")].alias("table_name"),
                                     F.col("key").alias("record_key")))
    for t in dict.fromkeys(r.table for r in rules if isinstance(r.check, KnownParent)):
        rows = [F.struct(F.lit(r.id).alias("rule_id"), F.lit(space(r.check.parent, r.check.parent_key)).alias("space"),
                         F.col(r.check.key).alias("key"), F.col(RECORD_KEY[t]).alias("record_key"))
                for r in rules if r.table == t and isinstance(r.check, KnownParent)]
        hit = _exploded(raw[t], rows).join(lost, (F.col("space") == F.col("_space")) & F.col("key").eqNullSafe(F.col("_key")))
        parts.append(hit.select("rule_id", F.lit(t).alias("table_name"), "record_key"))
    return union_all(parts)


def failed_records(raw: Mapping[str, DataFrame], rules: list[Rule] | None = None, keep: Keep = lambda df: df) -> DataFrame:
    """(rule_id, table_name, record_key) for every failure; a missing key reads ``None``. ``keep`` stores lost and repeated
    keys, if they are to be."""
    rules = RULES if rules is None else rules
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        row_rules = [r for r in rules if r.table == table and isinstance(r.check, RowCheck)]
        if row_rules:
            parts.append(_row_failures(raw[table], table, row_rules).withColumn("table_name", F.lit(table)))
    key_rules = [r for r in rules if isinstance(r.check, (UniqueKey, KnownParent))]
    if key_rules:
        parts.append(_key_failures(raw, key_rules, keep).select("rule_id", "record_key", "table_name"))
    for r in rules:
        if isinstance(r.check, FirstOnly):
            parts.append(_surplus(raw, r).withColumn("table_name", F.lit(r.table)))
        elif r not in key_rules and not isinstance(r.check, RowCheck):
            raise TypeError(f"rule {r.id} has an unknown check: {r.check!r}")
    return union_all(parts).select(
        "rule_id", "table_name", F.coalesce(F.col("record_key").cast("string"), F.lit("None")).alias("record_key"))


def unread_numbers(raw: dict[str, DataFrame]) -> DataFrame:
    """(table_name, record_key, column_name, raw_value) for every number that staging cannot keep: text that is no
    number, one too large, or one with more decimals than its type. Such a value becomes NULL or is rounded, so the
    rules never see it; this load check does. One pass over each table."""
    parts = []
    for table, df in raw.items():
        numbers = [c for c in NUMBER_COLUMNS[table] if c in df.columns]
        if not numbers:
            continue
        each = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("raw_value"), _lost(c).alias("lost")) for c in numbers))
        found = df.select(F.col(df.columns[0]).alias("record_key"), F.explode(each).alias("x")).filter("x.lost")
        parts.append(found.select(F.lit(table).alias("table_name"), "record_key", "x.column_name", "x.raw_value"))
    return union_all(parts)


def _lost(c: str) -> Column:
    kept = MONEY if c.endswith("_pkr") else SHARE if c == "copay_pct" else "int"
    same = f"try_cast({c} AS {kept}) = try_cast({c} AS decimal(38,12))"
    return F.expr(f"nullif({c}, '') IS NOT NULL AND NOT coalesce({same}, false)")


def catalogue(spark: SparkSession, rules: list[Rule] | None = None) -> DataFrame:
    rows = [(i, r.id, r.name, r.dimension.value, r.severity.value, r.table, r.column, r.threshold, WEIGHT[r.severity])
            for i, r in enumerate(RULES if rules is None else rules)]
    return spark.createDataFrame(rows, "rule_no int, rule_id string, rule_name string, dimension string, severity string, "
                                       "table_name string, column_name string, threshold double, weight int")


def results(raw: dict[str, DataFrame], failures: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per rule: rows checked and failed, rate, verdict."""
    rules = RULES if rules is None else rules
    tables = list(dict.fromkeys(r.table for r in rules))
    checked = union_all([count_rows(raw[t], t) for t in tables]).withColumnRenamed("row_count", "rows_checked")
    failed = failures.groupBy("rule_id").agg(F.count(F.lit(1)).alias("rows_failed"))
    out = (
        catalogue(failures.sparkSession, rules)
        .join(checked, "table_name", "left")
        .join(failed, "rule_id", "left")
        .withColumn("rows_failed", F.coalesce("rows_failed", F.lit(0)))
    )
    out = out.withColumn("fail_rate", F.coalesce(ratio("rows_failed", "rows_checked"), F.lit(0.0)))
    return out.withColumn("passed", F.col("fail_rate") <= F.col("threshold"))


# -- scores ----------------------------------------------------------------------
def score(results_: DataFrame, by: str | None = None) -> DataFrame:
    """100 x weighted mean of (1 - fail rate); 100 where there is nothing to weigh."""
    weights = F.create_map(*[x for s, w in WEIGHT.items() for x in (F.lit(s.value), F.lit(w))])
    w = weights[F.col("severity")].cast("double")
    num, den = F.sum(w * (1 - F.col("fail_rate"))), F.sum(w)
    value = F.coalesce(100 * ratio(num, den), F.lit(100.0)).alias("score")
    return results_.groupBy(by).agg(value) if by else results_.agg(value)


def scores(results_: DataFrame) -> DataFrame:
    """Overall, per dimension and per table, in one long frame."""
    frames = [score(results_).select(F.lit("overall").alias("scope"), F.lit("all").alias("name"), "score")]
    for scope, col in (("dimension", "dimension"), ("table", "table_name")):
        frames.append(score(results_, col).select(F.lit(scope).alias("scope"), F.col(col).alias("name"), "score"))
    return union_all(frames)


def critical_failures(results_: DataFrame) -> DataFrame:
    return results_.filter((F.col("severity") == "critical") & ~F.col("passed"))


#: What the gate calls the load check of numbers; it is no rule of the catalogue and carries no weight.
UNREAD = "LOAD-NUMBERS"


def check_gate(results_: DataFrame, unread: DataFrame | None = None) -> None:
    """Stops on a failed critical rule, and on numbers that staging would lose."""
    ids = [r.rule_id for r in critical_failures(results_).select("rule_id").orderBy("rule_id").collect()]
    if unread is not None and not unread.isEmpty():
        ids.append(UNREAD)
    if ids:
        raise QualityGateError(ids)


def report(results_: DataFrame) -> DataFrame:
    """The run as one nested row, rounded as published: two digits for scores, six for rates."""
    def packed(by: str) -> DataFrame:
        s = score(results_, by).select(F.struct(F.col(by).alias("k"), F.round("score", 2).alias("v")).alias("e"))
        return s.agg(F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("m"))

    rule = F.struct(
        "rule_no", "rule_id", F.col("rule_name").alias("name"), "dimension", "severity",
        F.col("table_name").alias("table"), F.col("column_name").alias("column"), "rows_checked", "rows_failed",
        F.round("fail_rate", 6).alias("fail_rate"), "passed")
    all_rules = results_.agg(  # one row per rule of the catalogue
        F.max("run_id").alias("run_id"), F.max("run_ts").alias("run_ts"),
        F.array_sort(F.collect_list(rule)).alias("rules"),
        F.array_sort(F.collect_list(F.when((F.col("severity") == "critical") & ~F.col("passed"), F.col("rule_id"))))
        .alias("critical_failures"))
    return all_rules.select(
        "run_id", "run_ts",
        score(results_).select(F.round("score", 2).alias("s")).scalar().alias("overall_score"),
        packed("dimension").scalar().alias("dimension_scores"),
        packed("table_name").scalar().alias("table_scores"),
        "critical_failures",
        F.transform("rules", lambda r: r.dropFields("rule_no")).alias("rules"))


# -- persisted runs --------------------------------------------------------------
@dataclass(frozen=True)
class QualityRun:
    run_id: int
    results: DataFrame
    unread: DataFrame

    def overall_score(self) -> float:
        return score(self.results).first()["score"]


RUN_IDS = "_run_ids"


class RunExists(ValueError):
    """A quality run of that id has been started before."""


def claim_run_id(lake: Lake, run_id: int | None = None, replace: bool = False) -> int:
    """An id that no other run has: the next free one, or ``run_id`` if it is free or is to be replaced.

    An id is claimed by making its marker exclusively in the lake's folder, before a row is written, so two runs that
    start at once get two ids.
    """
    spark, folder = lake.spark, lake.path("dq", RUN_IDS)
    stored = lake.read("dq", "dq_results") if lake.exists("dq", "dq_results") else None
    if run_id is None:
        last = stored.agg(F.max("run_id")).first()[0] if stored is not None else None  # runs older than the markers
        return commits.claim_next(spark, folder, {}, at_least=(last or 0) + 1)
    fresh = commits.create(spark, folder, run_id, {})
    known = not fresh or (stored is not None and not stored.filter(F.col("run_id") == run_id).isEmpty())
    if known and not replace:
        raise RunExists(f"quality run {run_id} exists; pass replace=True to write it again")
    return run_id


def run(lake: Lake, raw: Mapping[str, DataFrame], rules: list[Rule] | None = None, run_id: int | None = None,
        replace: bool = False) -> QualityRun:
    """Write the failing keys, count them from what was written, write the results.

    The run has an id of its own (``claim_run_id``). Tables are partitioned by run, and each write replaces just the
    partition of its run, so runs at the same time keep out of each other's way, and a run repeated after a failure
    (``run_id`` with ``replace``) leaves no second copy.
    """
    run_id = claim_run_id(lake, run_id, replace)
    now = F.current_timestamp()
    found = failed_records(raw, rules, lambda keys: lake.replace("work", f"bad_keys_{run_id}", keys)).select(F.lit(run_id).alias("run_id"), "*", now.alias("captured_at"))
    stored = lake.replace_partition("dq", "dq_failed_records", found, "run_id").filter(F.col("run_id") == run_id)
    res = results(raw, stored, rules).withColumns({"run_id": F.lit(run_id), "run_ts": now})
    kept = lake.replace_partition("dq", "dq_results", res.select(*RESULT_COLUMNS, "rule_no"), "run_id")
    lost = unread_numbers(raw).select(F.lit(run_id).alias("run_id"), "*", now.alias("captured_at"))
    quarantined = lake.replace_partition("dq", "dq_unread_numbers", lost, "run_id")
    mine = F.col("run_id") == run_id
    return QualityRun(run_id, kept.filter(mine), quarantined.filter(mine))


# -- reads over stored runs ------------------------------------------------------
def latest_run(stored: DataFrame) -> DataFrame:
    """Results of the last run; the run id is a scalar subquery and prunes partitions."""
    last = stored.agg(F.max("run_id").alias("r"))
    return stored.filter(F.col("run_id") == last.scalar()).orderBy("severity", "rule_id")


def trend(stored: DataFrame) -> DataFrame:
    from medledger.functions import mean_of

    return stored.groupBy("run_id").agg(
        mean_of("fail_rate").alias("avg_fail_rate"), F.sum("rows_failed").alias("total_failed")).orderBy("run_id")


def page_totals(results_: DataFrame) -> DataFrame:
    return results_.agg(
        F.count_if("passed").alias("rules_passed"), F.count(F.lit(1)).alias("rules_total"),
        F.sum("rows_failed").alias("rows_failed"),
        F.count_if((F.col("severity") == "critical") & ~F.col("passed")).alias("critical_failures"))


def failures_by_dimension(results_: DataFrame) -> DataFrame:
    return results_.groupBy("dimension").agg(F.sum("rows_failed").alias("rows_failed"))


# Which rule must catch which injected defect.
DEFECT_RULES = {
    "duplicate_claims": "U-HDR-BIZDUP",
    "null_values": "C-HDR-ADJMODE",
    "orphan_fk_member": "R-HDR-MEMBER-FK",
    "orphan_fk_provider": "R-HDR-PROVIDER-FK",
    "date_violations": "K-HDR-DISCHARGE",
    "amount_violations": "A-HDR-PAID-APPR",
    "nonpositive_amounts": "A-HDR-NONNEG",
    "impossible_ages": "V-MBR-AGE",
    "city_casing_members": "K-MBR-CITY",
    "city_casing_providers": "K-PRV-CITY",
    "city_casing_groups": "K-GRP-CITY",
}


def reconcile_defects(results_: DataFrame, manifest: DataFrame) -> DataFrame:
    """Injected against caught, per defect class."""
    pairs = results_.sparkSession.createDataFrame(list(DEFECT_RULES.items()), "defect string, rule_id string")
    return (
        manifest.join(pairs, "defect").join(results_.select("rule_id", "rows_failed"), "rule_id")
        .select("defect", "rule_id", "injected", F.col("rows_failed").alias("caught"),
                (F.col("injected") == F.col("rows_failed")).alias("matches"))
    )
