import pytest

from wearlens.operators import runs

SCHEMA = "run_id string, batch_id string, batch_no int, seq int, val_recall double, val_pr_auc double, val_expected_cost_per_1000 double"
NO_CHAMPION = "alias string, version int, run_id string, val_expected_cost_per_1000 double"


@pytest.fixture(scope="module")
def table(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(f"r{i}", b, int(b[1:]), i, r, p, c) for i, (b, r, p, c) in enumerate(rows)], SCHEMA
        )

    return make


def decision(spark, table, champion):
    frame = spark.createDataFrame([champion] if champion else [], NO_CHAMPION)
    return runs.champion_challenger(table, "b0", frame, 7)


def test_cheapest_passing_run_wins(table):
    df = table(("b0", 0.4, 0.9, 10.0), ("b0", 0.6, 0.5, 30.0), ("b0", 0.7, 0.6, 20.0), ("b0", None, 0.1, 1.0))
    best = runs.select_best(df).first()
    assert best.run_id == "r2" and best.passes_gate
    up = runs.runner_up(df).first()
    assert up.runner_up_id == "r0" and up.cost_gap == -10
    gate = runs.gate_stats(df).first()
    assert (gate.runs, gate.passing) == (4, 2)
    assert [r.run_id for r in runs.leaderboard(df).orderBy("rank").collect()] == ["r3", "r0", "r2", "r1"]


def test_no_run_passes(spark, table):
    df = table(("b0", 0.4, 0.9, 12.0), ("b0", 0.3, 0.5, 11.0))
    assert runs.select_best(df).first().run_id == "r1"
    row = decision(spark, df, None).first()
    assert row.beats_champion and not row.promoted_to_production
    assert [r.alias for r in runs.bootstrap(df).collect()] == ["staging"]


def test_tie_is_not_promoted_but_staged(spark, table):
    df = table(("b0", 0.853, 0.6, 52.5))
    out = decision(spark, df, ("production", 3, "old", 52.5))
    row = out.first()
    assert not row.beats_champion and not row.promoted_to_production and row.champion_version == 3
    assert row.reason == "candidate cost 52.5/1000 does not beat production's 52.5/1000"
    assert [tuple(r) for r in runs.alias_events(out).collect()] == [("staging", 7, 7)]


def test_first_promotion_and_lower_cost(spark, table):
    df = table(("b0", 0.853, 0.6, 51.0))
    row = decision(spark, df, None).first()
    assert row.promoted_to_production and row.champion_version is None and "first promotion" in row.reason
    out = decision(spark, df, ("production", 3, "old", 52.5))
    assert out.first().promoted_to_production
    assert {r.alias for r in runs.alias_events(out).collect()} == {"staging", "production"}
    assert {r.alias for r in runs.bootstrap(df).collect()} == {"staging", "production"}


def test_unknown_batch(table):
    with pytest.raises(ValueError, match="b9"):
        runs.runs_of_batch(table(("b0", 0.5, 0.5, 1.0)), "b9")


@pytest.mark.parametrize("rows_per_slice", [2, 1000])
def test_history_equals_deciding_one_by_one(spark, table, rows_per_slice):
    costs = [(0.6, 50.0), (0.9, 50.0), (0.3, 10.0), (0.7, 40.0), (0.8, 45.0), (0.5, 39.9)]
    df = table(*[(f"b{i}", r, 0.5, c) for i, (r, c) in enumerate(costs)])
    got = runs.promotion_history(df, rows_per_slice=rows_per_slice).orderBy("batch_no").collect()
    best = None
    for i, (r, c) in enumerate(costs):
        wins = r >= 0.5 and (best is None or c < best[1])
        assert got[i].promoted_to_production == wins and got[i].champion_version == (best[0] if best else None)
        best = (i + 1, c) if wins else best
    versions = spark.createDataFrame([(i + 1, f"r{i}") for i in range(6)], "version int, run_id string")
    champion = runs.champion(runs.alias_events(runs.promotion_history(df)), versions, df).first()
    assert (champion.version, champion.run_id) == (6, "r5")
