"""Run selection and promotion as queries over run, version and alias tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wearlens.contract import RECALL_FLOOR
from wearlens.operators.ordered import ROWS_PER_SLICE, running_totals

COST = "val_expected_cost_per_1000"


def runs_of_batch(runs: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Runs by ascending cost; a batch without runs is an error."""
    picked = runs if batch_id is None else runs.filter(F.col("batch_id") == batch_id)
    if picked.isEmpty():
        raise ValueError(f"no runs with batch_id={batch_id!r}" if batch_id else "no runs")
    return picked.orderBy(COST, "seq")


def passes_gate(floor: float = RECALL_FLOOR):
    return F.coalesce(F.col("val_recall"), F.lit(0.0)) >= floor


def leaderboard(runs: DataFrame, by: list[str] = ("batch_id",)) -> DataFrame:
    """Runs ranked by ascending validation cost inside each batch."""
    spec = Window.partitionBy(*by).orderBy(COST, "seq")
    return runs.withColumn("rank", F.row_number().over(spec))


def _first_by(order: list, columns: list[str]):
    """The columns of the row with the least ``order`` tuple, as one aggregate."""
    return F.min_by(F.struct(*columns), F.struct(*order))


def select_best(runs: DataFrame, floor: float = RECALL_FLOOR, by: list[str] = ("batch_id",)) -> DataFrame:
    """Cheapest run that passes the recall gate, or the cheapest of all where none passes."""
    order = [(~passes_gate(floor)).alias("fails"), F.col(COST).alias("cost"), F.col("seq")]
    wanted = ["run_id", "seq", "val_recall", "val_pr_auc", COST]
    return (
        runs.groupBy(*by)
        .agg(_first_by(order, wanted).alias("b"))
        .select(*by, "b.*")
        .withColumn("passes_gate", passes_gate(floor))
    )


def runner_up(runs: DataFrame, floor: float = RECALL_FLOOR, by: list[str] = ("batch_id",)) -> DataFrame:
    """The run with the highest PR-AUC beside the selected one, and what it would cost more."""
    by = list(by)
    order = [(-F.coalesce(F.col("val_pr_auc"), F.lit(0.0))).alias("down"), F.col("seq")]
    top = runs.groupBy(*by).agg(_first_by(order, ["run_id", "val_pr_auc", COST]).alias("t")).select(
        *by,
        F.col("t.run_id").alias("runner_up_id"),
        F.col("t.val_pr_auc").alias("runner_up_pr_auc"),
        F.col(f"t.{COST}").alias("runner_up_cost"),
    )
    best = select_best(runs, floor, by).select(*by, F.col("run_id").alias("best_id"), F.col(COST).alias("best_cost"))
    return best.join(top, by).withColumn("cost_gap", F.col("runner_up_cost") - F.col("best_cost"))


def gate_stats(runs: DataFrame, floor: float = RECALL_FLOOR, by: list[str] = ("batch_id",)) -> DataFrame:
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(passes_gate(floor)).alias("passing")
    )


def alias_target(aliases: DataFrame, alias: str) -> DataFrame:
    """``alias, version`` as the newest event left it; no row when the alias was never set."""
    return (
        aliases.filter(F.col("alias") == alias)
        .groupBy("alias")
        .agg(F.max_by("version", "seq").alias("version"))
    )


def champion(aliases: DataFrame, versions: DataFrame, runs: DataFrame, alias: str = "production") -> DataFrame:
    """``alias, version, run_id`` and its validation cost."""
    target = alias_target(aliases, alias)
    return (
        target.join(versions, "version", "left")
        .join(runs.select("run_id", COST), "run_id", "left")
        .select("alias", "version", "run_id", COST)
    )


def _reason(champion_cost):
    def cost(c):
        return F.format_string("%.1f", F.bround(c, 1))

    return F.when(champion_cost.isNull(), "no current production model — first promotion").otherwise(
        F.concat(
            F.lit("candidate cost "), cost(F.col("candidate_cost_per_1000")), F.lit("/1000 "),
            F.when(F.col("candidate_cost_per_1000") < champion_cost, "beats").otherwise("does not beat"),
            F.lit(" production's "), cost(champion_cost), F.lit("/1000"),
        )
    )


def decide(candidates: DataFrame) -> DataFrame:
    """Decision columns from candidate and champion costs: the gate, then strictly lower cost."""
    lower = F.col("champion_cost_per_1000").isNull() | (
        F.col("candidate_cost_per_1000") < F.col("champion_cost_per_1000")
    )
    return candidates.withColumns(
        {
            "beats_champion": lower,
            "promoted_to_production": F.col("passes_recall_gate") & lower,
            "reason": _reason(F.col("champion_cost_per_1000")),
        }
    )


def _candidate(best: DataFrame) -> DataFrame:
    return best.withColumnsRenamed(
        {
            "run_id": "candidate_run_id",
            "val_recall": "candidate_recall",
            COST: "candidate_cost_per_1000",
            "passes_gate": "passes_recall_gate",
        }
    ).drop("val_pr_auc", "seq")


def champion_challenger(runs: DataFrame, batch_id: str, champion_row: DataFrame, next_version: int) -> DataFrame:
    """Decision of one batch against the current champion (an empty frame when there is none)."""
    best = _candidate(select_best(runs_of_batch(runs, batch_id)))
    current = champion_row.agg(
        F.max("version").alias("champion_version"), F.max(COST).alias("champion_cost_per_1000")
    )
    joined = best.withColumns(
        {
            "candidate_version": F.lit(next_version),
            "champion_version": current.select("champion_version").scalar(),
            "champion_cost_per_1000": current.select("champion_cost_per_1000").scalar(),
        }
    )
    return decide(joined)


def alias_events(decision: DataFrame, seq: str = "candidate_version") -> DataFrame:
    """``alias, version, seq``: every candidate is staged; a promoted one also takes production."""
    both = F.array(F.lit("staging"), F.when(F.col("promoted_to_production"), "production"))
    return decision.select(
        F.explode(F.filter(both, lambda a: a.isNotNull())).alias("alias"),
        F.col("candidate_version").alias("version"),
        F.col(seq).alias("seq"),
    )


def bootstrap(runs: DataFrame, version: int = 1) -> DataFrame:
    """Alias events of a first promotion: staging always, production when the gate passes."""
    best = _candidate(select_best(runs.withColumn("batch_id", F.lit("all"))))
    first = best.withColumns(
        {"candidate_version": F.lit(version), "champion_cost_per_1000": F.lit(None).cast("double")}
    )
    return alias_events(decide(first))


def promotion_history(
    runs: DataFrame, batch_order: str = "batch_no", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """The decisions of all batches in order, each against the champion its predecessors left.

    A promotion needs strictly lower cost, so the champion before a batch is the first cheapest
    gate-passing candidate so far: a running minimum, not a loop.
    """
    best = _candidate(select_best(runs, by=["batch_id", batch_order]))
    ranked = best.withColumn("candidate_version", F.col(batch_order) + 1).withColumn(
        "__holder",
        F.when(F.col("passes_recall_gate"), F.struct("candidate_cost_per_1000", "candidate_version")),
    )
    run = running_totals(ranked, [], batch_order, [], rows_per_slice, minima=["__holder"])
    before = F.col("__holder_min_before")
    return decide(
        run.withColumns(
            {
                "champion_version": before["candidate_version"],
                "champion_cost_per_1000": before["candidate_cost_per_1000"],
            }
        ).drop("__holder", "__holder_min_before", f"{batch_order}_next")
    )
