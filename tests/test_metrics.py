import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stargrain.operators.checks import undocumented
from stargrain.operators.metrics import Join, MetricView, average, distinct, highest, total


@pytest.fixture
def view(spark, frame):
    facts = frame(
        "id int, team int, day int, goals int, shots int, p double",
        (1, 1, 1, 2, 4, 50.0), (2, 1, 2, 0, 0, None), (3, 2, 1, 1, 2, 30.0), (4, None, 1, 3, None, 10.0),
    )
    teams = spark.sql("SELECT * FROM VALUES (1, 'x', 'r'), (2, 'y', 'r') AS t(id, name, region)")

    def make(coarse=True):
        return MetricView(
            facts,
            {"team": "source.team", "day": "source.day", "name": "team.name", "region": "team.region"},
            {
                "goals": total("goals"),
                "conversion": total("goals").over(total("shots")),
                "balance": total("goals") - total("shots"),
                "possession": average("p"),
                "best": highest("goals"),
                "n": distinct("id"),
            },
            {"team": Join(teams, {"team": "id"}, coarse)},
            {"goals": "Goals."},
        )

    return make


def test_ratio_of_sums_not_mean_of_ratios(view):
    got = view().query(["region"], ["goals", "conversion", "possession", "best", "balance"])
    assert rows_of(got) == [("r", 3, 0.5, 40.0, 2, -3), (None, 3, None, 10.0, 3, None)]


def test_same_answer_with_and_without_aggregating_first(spark, view):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    measures = ["goals", "conversion", "possession", "best"]
    assert rows_of(view(True).query(["name", "day"], measures)) == rows_of(view(False).query(["name", "day"], measures))


def test_small_dimensions_join_in_place(view):
    plan = view().query(["region"], ["goals"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_aggregating_first_comes_before_a_shuffled_join(spark, view):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = view().query(["region"], ["goals"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2
    # A distinct count keeps its values through the join, see test_digests.py.
    assert rows_of(view().query(["region"], ["n"])) == [("r", 3), (None, 1)]


def test_unreferenced_joins_are_left_out(view):
    plan = view().query(["day"], ["goals"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_dimension_given_as_a_function_is_built_on_demand(spark, frame):
    calls = []

    def teams():
        calls.append(1)
        return spark.sql("SELECT 1 AS id, 'x' AS name")

    view = MetricView(
        frame("team int, goals int", (1, 2)), {"team": "source.team", "name": "team.name"},
        {"goals": total("goals")}, {"team": Join(teams, {"team": "id"})},
    )
    assert rows_of(view.query(["team"], ["goals"])) == [(1, 2)] and not calls
    assert rows_of(view.query(["name"], ["goals"])) == [("x", 2)] and calls


def test_where_and_having(view):
    got = view().query(["name"], ["goals"], where=lambda d: d("day") == 1, having=F.col("goals") > 1)
    assert rows_of(got) == [("x", 2), (None, 3)]
    assert rows_of(view().query([], ["goals"], where=lambda d: d("region") == "r")) == [(3,)]


def test_dimensions_only_and_comments(view):
    assert rows_of(view().query(["region"], [])) == [("r",), (None,)]
    assert undocumented(view().query(["day"], ["goals"])) == ["day"]


def test_unknown_names_are_refused(view):
    with pytest.raises(KeyError):
        view().query(["nothing"], ["goals"])
    with pytest.raises(KeyError):
        view().query(["day"], ["nothing"])
