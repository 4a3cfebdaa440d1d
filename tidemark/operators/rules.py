"""Declarative data-quality rules.

One rule list per source yields the accepted rows, the row details, the per-rule
summary and the rollup. A rule is a named Spark predicate, so users add rules without
touching the operators.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clean
from tidemark.operators import profile, skew


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a violating row; NULL counts as not violating.

    The details only test rows where ``guard`` holds. The summary is not guarded
    unless ``guard_summary`` is set: both reports exist and differ on purpose.
    """

    code: str
    rule_type: str
    severity: str
    reason: str
    fails: Column
    guard: Column | None = None
    guard_summary: bool = False

    def detail_fails(self) -> Column:
        return F.coalesce(self.fails if self.guard is None else self.guard & self.fails, F.lit(False))

    def summary_fails(self) -> Column:
        return self.detail_fails() if self.guard_summary else F.coalesce(self.fails, F.lit(False))


@dataclass(frozen=True)
class DuplicateRule:
    """More than one row with the same key.

    Details look rows up by ``keys`` in the repeated groups of ``group_keys`` (default:
    the same) and skip NULL keys. The summary counts rows of ``summary_keys`` groups,
    where NULL forms a group unless ``summary_skips_null`` for the last key.
    """

    code: str
    reason: str
    keys: Sequence[Column]
    summary_keys: Sequence[Column]
    group_keys: Sequence[Column] | None = None
    summary_skips_null: bool = False
    rule_type: str = "duplicate"
    severity: str = "reject"


@dataclass(frozen=True)
class RuleSet:
    source_name: str
    source_table: str
    rules: Sequence[Rule]
    duplicate: DuplicateRule | None
    key: Column
    payload: Sequence[str]

    def all_rules(self) -> list:
        """Report order: the duplicate rule comes second."""
        listed = list(self.rules)
        if self.duplicate is not None:
            listed.insert(1, self.duplicate)
        return listed


def accepted(rules: RuleSet) -> Column:
    """Whether a row breaks no reject rule."""
    out = F.lit(True)
    for rule in rules.rules:
        if rule.severity == "reject":
            out = out & ~F.coalesce(rule.fails, F.lit(False))
    return out


def accept_rows(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Rows that break no reject rule. Duplicates stay; the dedup step keeps one.

    Guards play no part: they only decide which rule a report names.
    """
    for rule in rules.rules:
        if rule.severity == "reject":
            df = df.filter(~F.coalesce(rule.fails, F.lit(False)))
    return df


LINEAGE = ("load_run_id", "source_file", "source_row_number")


def _verdict(rule, rules: RuleSet) -> list[Column]:
    return [
        F.lit(rules.source_name).alias("source_name"),
        F.lit(rules.source_table).alias("source_table"),
        F.lit(rule.code).alias("rule_code"),
        F.lit(rule.rule_type).alias("rule_type"),
        F.lit(rule.severity).alias("dq_verdict"),
        F.lit(rule.reason).alias("reason"),
    ]


def _complete(keys: Sequence[Column]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & k.isNotNull()
    return out


def duplicate_rows(df: DataFrame, keys: Sequence[Column], group_keys: Sequence[Column] | None = None) -> DataFrame:
    """Every member of a key group with more than one row; NULL keys never match.

    With ``group_keys`` the rows are looked up by ``keys`` in the groups of those. A narrow
    pass counts the keys; of the rows themselves only candidates are shuffled.
    """
    known = profile.repeated_keys(df, keys if group_keys is None else group_keys)
    marked = profile.mark_repeated(df.withColumn("__key", F.when(_complete(keys), skew.struct_key(keys))), "__key", known, "__maybe")
    return marked.filter("__maybe").join(known, "__key", "left_semi").select(*df.columns)


def dq_details(
    df: DataFrame, rules: RuleSet, with_payload: bool = True, codes: Sequence[str] | None = None, repeated: DataFrame | None = None
) -> DataFrame:
    """One row per (row, failed rule), for the rules in ``codes`` (default: all).

    All rules are evaluated in one pass over the rows without a shuffle. The duplicate rule
    needs the repeated keys, from a narrow pass of their own or given as ``repeated``; rows
    that may hold one are told by a broadcast filter, and only the findings are then joined
    with the keys. Nothing runs before the result is asked for.
    """
    if codes is not None:
        dup = rules.duplicate if rules.duplicate is not None and rules.duplicate.code in codes else None
        rules = replace(rules, rules=[r for r in rules.rules if r.code in codes], duplicate=dup)
        if not rules.all_rules():
            raise ValueError(f"no rule of {rules.source_name} has a code in {list(codes)}")
    shown = [*LINEAGE, rules.key.alias("business_key")]
    if with_payload:
        shown.append(clean.raw_payload(rules.payload).alias("raw_payload"))
    fails = [r.detail_fails() for r in rules.rules]
    tested = list(rules.rules)
    if (dup := rules.duplicate) is not None:
        known = _repeated(df, dup) if repeated is None else repeated
        df = df.withColumn("__key", F.when(_complete(dup.keys), skew.struct_key(dup.keys)))
        df = profile.mark_repeated(df, "__key", known, "__maybe")
        fails.append(F.col("__maybe"))
        tested.append(dup)
        shown.append(F.col("__key"))
    # Positions of the failed rules; the texts are looked up for failing rows only.
    failed = F.array(*[F.when(f, F.lit(i + 1)) for i, f in enumerate(fails)])
    texts = F.array(*[F.struct(*_verdict(r, rules)) for r in tested])
    hits = df.select("*", F.explode(failed).alias("__i")).filter("__i is not null").select(*shown, "__i")
    if dup is not None:
        # Findings of other rules match nothing; their second join key spreads them.
        mine = F.col("__i") == len(fails)
        spread = F.when(mine, 0).otherwise(1 + F.pmod(F.xxhash64(*LINEAGE), F.lit(skew.SALTS))).cast("int")
        sure = known.select("__key", F.lit(0).alias("__salt"), F.lit(True).alias("__sure"))
        hits = hits.withColumn("__salt", spread).join(sure, ["__key", "__salt"], "left")
        hits = hits.filter(~mine | F.col("__sure")).drop("__key", "__salt", "__sure")
    names = [c for c in hits.columns if c != "__i"]
    return hits.select(*names, F.element_at(texts, F.col("__i")).alias("__v")).select(*names, "__v.*")


def _repeated(df: DataFrame, rule: DuplicateRule) -> DataFrame:
    return profile.repeated_keys(df, rule.keys if rule.group_keys is None else rule.group_keys)


def summary_metrics(rules: RuleSet) -> dict[str, Column]:
    """What the summary counts over all rows, to be taken while these are written."""
    return {"__total": F.count(F.lit(1)), **{f"__c{i}": F.count_if(r.summary_fails()) for i, r in enumerate(rules.rules)}}


def duplicate_row_count(repeated: DataFrame, rule: DuplicateRule) -> DataFrame:
    """One row: how many rows sit in groups of more than one, from the repeated ``summary_keys``."""
    if rule.summary_skips_null:
        repeated = repeated.filter(F.col("__key")[f"k{len(rule.summary_keys) - 1}"].isNotNull())
    return repeated.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("__dup"))


def dq_summary(
    df: DataFrame, rules: RuleSet, load_run_id: str = "run", counts: Mapping[str, int] | None = None, repeated: DataFrame | None = None
) -> DataFrame:
    """Passed, failed and warning counts per rule.

    ``counts`` (of ``summary_metrics``) and ``repeated`` (the repeated ``summary_keys``)
    spare the passes over ``df`` where they are known.
    """
    if counts is None:
        row = df.agg(*[c.alias(n) for n, c in summary_metrics(rules).items()])
    else:
        row = df.sparkSession.range(1).select(*[F.lit(counts[n]).cast("bigint").alias(n) for n in summary_metrics(rules)])
    position = {id(r): f"__c{i}" for i, r in enumerate(rules.rules)}
    if (dup := rules.duplicate) is not None:
        repeated = profile.repeated_keys(df, dup.summary_keys) if repeated is None else repeated
        row = row.crossJoin(duplicate_row_count(repeated, dup))  # one row each
    entries = []
    for r in rules.all_rules():
        hits = F.col(position.get(id(r), "__dup")).cast("bigint")
        zero = F.lit(0).cast("bigint")
        warn = r.severity == "warning"
        entries.append(
            F.struct(
                F.lit(r.code).alias("rule_code"),
                F.lit(r.rule_type).alias("rule_type"),
                F.lit(r.severity).alias("severity"),
                F.greatest(F.col("__total") - hits, zero).alias("passed_count"),
                (zero if warn else hits).alias("failed_count"),
                (hits if warn else zero).alias("warning_count"),
            )
        )
    return (
        row.select(F.explode(F.array(*entries)).alias("s"))
        .select("s.*")
        .withColumns({"source_name": F.lit(rules.source_name), "load_run_id": F.lit(load_run_id)})
    )


def dq_rollup(summary: DataFrame, checked_at: str | None = None) -> DataFrame:
    """Per run, source and rule type: sums and an overall status."""
    aggs = [F.count(F.lit(1)).alias("rule_count")]
    aggs += [F.sum(f"{c}_count").alias(f"{c}_count") for c in ("passed", "failed", "warning")]
    if checked_at:
        aggs.append(F.max(checked_at).alias("checked_at"))
    status = (
        F.when(F.col("failed_count") == 0, "DQ_PASSED")
        .when(F.col("passed_count") + F.col("warning_count") == 0, "DQ_FAILED")
        .otherwise("DQ_PARTIAL_PASSED")
    )
    return summary.groupBy("load_run_id", "source_name", "rule_type").agg(*aggs).withColumn("status", status)


class GateClosed(RuntimeError):
    """A source did not finish with SUCCESS."""


def gate_offenders(control: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """Sources whose last status is not SUCCESS; a missing status counts as failed."""
    if sources is not None:
        control = control.filter(F.col("source_name").isin(list(sources)))
    return control.filter(~F.col("status").eqNullSafe("SUCCESS"))


def dq_gate(control: DataFrame, sources: Sequence[str] | None = None) -> None:
    """Stop before the next layer when any source failed (control holds one row per source)."""
    bad = [r["source_name"] for r in gate_offenders(control, sources).select("source_name").collect()]
    if bad:
        raise GateClosed("sources not ready: " + ", ".join(sorted(bad)))


def check_constraints(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Violations per named predicate, all in one scan: check_name, bad_rows."""
    names = list(checks)
    row = df.agg(*[F.count_if(F.coalesce(checks[n], F.lit(False))).alias(f"c{i}") for i, n in enumerate(names)])
    items = [F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("bad_rows")) for i, n in enumerate(names)]
    return row.select(F.explode(F.array(*items)).alias("s")).select("s.*")


def check_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first of each key."""
    extra = skew.key_counts(df, keys).agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("bad_rows"))
    return extra.select(F.lit(name).alias("check_name"), "bad_rows")


def check_reference(df: DataFrame, dim: DataFrame, key: str, dim_key: str, same: Column, name: str) -> DataFrame:
    """Rows whose referenced row breaks ``same`` (columns prefixed ``d_`` come from ``dim``)."""
    ref = dim.select(*[F.col(c).alias(f"d_{c}") for c in dim.columns])
    bad = df.join(ref, F.col(key) == F.col(f"d_{dim_key}")).agg(F.count_if(~same).alias("bad_rows"))
    return bad.select(F.lit(name).alias("check_name"), "bad_rows")
