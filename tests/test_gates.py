"""Gates, decisions and rollups on small tables."""

import pytest
from pyspark.sql import functions as F

from loomwright.operators import decisions, gates, rollups


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(1, 5, "a"), (2, -1, "b"), (3, None, None), (4, 200, "a")], "id int, v int, s string")


RULES = lambda: [gates.Rule("range", ~F.col("v").between(0, 100)), gates.Rule("state", ~F.col("s").isin("a", "b"), F.lit(3))]


def test_gates(spark, rows):
    assert {tuple(r) for r in gates.counted(rows, RULES()).collect()} == {("range", 3), ("state", 3)}
    assert {tuple(r) for r in gates.counted(rows.limit(0), RULES()).collect()} == {("range", 0), ("state", 0)}
    assert sorted(map(tuple, gates.violators(rows, ["id"], RULES()).collect())) == [(2, "range"), (3, "range"), (3, "state"), (4, "range")]
    good, bad = gates.quarantined(rows, RULES())
    assert [r.id for r in good.collect()] == [1] and {r.id: r.gates for r in bad.collect()} == {2: ["range"], 3: ["range", "state"], 4: ["range"]}
    assert gates.passed(good, gates.counted(good, RULES())).count() == 1
    with pytest.raises(Exception, match="gates failed: range: 3, state: 3"):
        gates.passed(rows, gates.counted(rows, RULES())).collect()


def test_rollup_keeps_every_flag(spark):
    lines = [(1, 10, 3, "n", 5), (1, 10, 1, "x", 4), (1, 11, 2, None, 9), (1, None, 9, "zz", 1), (2, 7, None, None, None), (None, 1, 1, "a", 1)] + [(9, i % 100, i, f"f{i % 7}", i) for i in range(2000)]
    df = spark.createDataFrame(lines, "part long, o long, rank long, flag string, day long")
    got = {r.part: tuple(r)[1:] for r in rollups.by_key(df, "part", "o", "rank", "flag", "day").collect()}
    assert got == {1: (1, 2, "n; x; zz", 1, 9), 2: (None, 1, "", None, None), None: (1, 1, "a", 1, 1), 9: (0, 100, "; ".join(f"f{k}" for k in range(7)), 0, 1999)}


def test_decisions(spark):
    columns = "id int, assigned string, best double, second double, model double, token boolean, relationship string, confidence double"
    cases = [
        ((1, "e", 0.9, None, 0.9, True, "same_event", 0.99), "existing_assignment", False),
        ((2, None, None, None, None, None, None, None), "new_event", False),
        ((3, None, 0.9, 0.8, 0.9, False, "same_event", 0.95), "auto_merge", True),
        ((4, None, 0.9, 0.88, 0.9, False, "same_event", 0.95), "review", True),
        ((5, None, 0.6, None, 0.36, True, "same_event", 0.88), "auto_merge", True),
        ((6, None, 0.6, None, 0.2, False, "same_event", 0.99), "new_event", False),
        ((7, None, 0.71, None, 0.4, False, "unclear", 0.5), "new_event", True),
        ((8, None, 0.72, None, 0.4, False, "unclear", 0.5), "review", True),
        ((9, None, 0.82, None, 0.7, False, "not_same_event", 0.9), "review", True),
        ((10, None, 0.82, None, 0.69, False, "not_same_event", 0.9), "new_event", True),
        ((11, None, 0.9, None, 0.9, None, None, None), "new_event", True),
    ]
    got = {r.id: r for r in decisions.resolved(spark.createDataFrame([c for c, _, _ in cases], columns)).collect()}
    assert [(got[c[0]].decision, got[c[0]].asked) for c, _, _ in cases] == [(d, a) for _, d, a in cases]
    assert got[4].review_reason == f"{decisions.NOT_MET}; {decisions.PLAUSIBLE}" and got[3].review_reason is None
