import json

import pytest

from lakeloom.functions.rescue import rescued_columns, rescued_fields
from lakeloom.session import scratch
from lakeloom.streaming import flows as T
from tests.helpers import rows

SCHEMA = "id int, price double, tags array<struct<k:string>>, roi struct<times:double, at:struct<day:date>>, more map<string,int>"

LINES = {
    '{"id":1,"price":2.5}': None,
    '{"id":1,"price":2.5,"new":{"b":1,"a":[1,null]}}': {"new": {"a": [1, None], "b": 1}},
    '{"id":"x","price":"2"}': {"id": "x", "price": "2"},
    '{"ID":1,"Price":null}': {"ID": 1, "Price": None},
    '{"id":null,"price":null}': None,
    '{"id":3,"tags":[{"k":"a"},{"k":"b","v":1},{"w":2}]}': {"tags": [None, {"v": 1}, {"w": 2}]},
    '{"id":3,"tags":[{"k":"a"}],"roi":{"times":1.5,"currency":"chf"}}': {"roi": {"currency": "chf"}},
    '{"id":3,"roi":{"times":"often","at":{"day":"2024-01-02","hour":3}}}': {"roi": {"at": {"hour": 3}, "times": "often"}},
    '{"id":3,"roi":"none"}': {"roi": "none"},
    '{"id":3,"tags":{"k":"a"}}': {"tags": {"k": "a"}},
    '{"id":3,"more":{"a":1,"b":"two"}}': {"more": {"a": 1, "b": "two"}},
    '{"id":3,"more":{"a":1}}': None,
    '{"id":4.5}': {"id": 4.5},
    "[1,2]": {"_corrupt_record": "[1,2]"},
    "no json": {"_corrupt_record": "no json"},
    "": {"_corrupt_record": ""},
}


def test_nothing_that_does_not_fit_is_lost(spark):
    df = spark.createDataFrame([*((i, x) for i, x in enumerate(LINES)), (99, None)], "n int, value string")
    got = {r.n: r for r in rescued_fields(df, SCHEMA).collect()}
    for i, (line, want) in enumerate(LINES.items()):
        found = got[i]._rescued_data
        assert (json.loads(found) if found is not None else None) == want, line
    assert got[99]._rescued_data is None and got[99].id is None
    assert got[1].price == 2.5 and got[7].roi.at.day.isoformat() == "2024-01-02" and got[5].tags[1].k == "b" and got[11].more == {"a": 1}


def test_stream_and_batch_agree_over_drifting_files(spark):
    source, out = scratch(spark, "in"), scratch(spark, "out")
    spark.createDataFrame([(x,) for x in LINES], "value string").repartition(3).write.text(source)
    T.run_to_files(T.json_stream(spark, source, SCHEMA, files_per_batch=1), f"{out}/data", f"{out}/check")
    batch = rescued_fields(spark.read.text(source), SCHEMA)
    assert sorted(map(str, spark.read.parquet(f"{out}/data").select(*batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_columns_of_later_files_are_rescued(spark):
    source, out = scratch(spark, "in"), scratch(spark, "out")
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(source)
    spark.createDataFrame([(2, "b", 5, None), (3, None, None, None)], "id int, x string, extra int, y string").write.mode("append").parquet(source)
    for _ in range(2):
        T.run_to_files(T.drifting_stream(spark, source, "id int, x string, gone date"), f"{out}/data", f"{out}/check")
    got = rows(spark.read.parquet(f"{out}/data").select("id", "x", "gone", "_rescued_data"))
    assert got == [(1, "a", None, None), (2, "b", None, '{"extra":5}'), (3, None, None, None)]
    wide = spark.createDataFrame([(2, 7)], "id int, z int")
    assert rows(rescued_columns(wide, "id int")) == [(2, '{"z":7}')]


def test_clashing_names_are_refused(spark):
    with pytest.raises(ValueError, match="clash"):
        rescued_fields(spark.createDataFrame([("{}", 1)], "value string, id int"), "id int")
