import pytest

from lakeloom.operators import quality as Q
from tests.helpers import rows

RULES = {"adult": "age >= 18", "named": "name IS NOT NULL"}


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, 20, "a"), (2, 10, "b"), (3, None, "c"), (4, 30, None)], "id int, age int, name string")


def test_null_counts_as_failed(people):
    checked = Q.expect(people, RULES, "warn")
    assert rows(checked.metrics) == [("adult", 2, 2), ("named", 3, 1)]
    assert checked.rows.count() == 4


def test_drop_removes_failing_rows(people):
    assert [r[0] for r in rows(Q.expect(people, RULES, "drop").rows)] == [1]


def test_fail_stops_the_job_and_names_the_rule(people):
    with pytest.raises(Exception, match="expectation failed: adult"):
        Q.expect(people.filter("id <= 2"), RULES, "fail").rows.collect()
    assert Q.expect(people.filter("id = 1"), RULES, "fail").rows.count() == 1


def test_fail_also_stops_a_pruned_read(people):
    with pytest.raises(Exception, match="expectation failed"):
        Q.expect(people, RULES, "fail").rows.select("id").collect()


def test_unknown_action(people):
    with pytest.raises(ValueError):
        Q.expect(people, RULES, "ignore")


def test_counts_keys_missing(spark, people):
    assert rows(Q.count_check(people, people.limit(3))) == [(4, 3, False)]
    silver = spark.createDataFrame([(1,), (4,)], "id int")
    assert [r[-1] for r in rows(Q.missing_records(people, silver, "id").select("id", "target_key"))] == [1, None, None, 4]
    twice = people.union(people.limit(1))
    assert sum(not r[-1] for r in rows(Q.key_counts(twice, ["id"]))) == 1


def test_quarantine_flag_needs_all_rules(people):
    flagged = Q.quarantine(people, RULES)
    assert [r[0] for r in rows(Q.valid(flagged).select("id"))] == [1]
    assert [r[0] for r in rows(Q.invalid(flagged).select("id"))] == [2, 3, 4]


def test_watched_counts_come_with_the_rows(people):
    for action, kept in (("warn", 4), ("drop", 1)):
        watched = Q.watch(people, RULES, action)
        assert len(watched.rows.collect()) == kept
        assert watched.counts() == [("adult", 2, 2), ("named", 3, 1)]
