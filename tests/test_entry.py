"""The driver contract."""

import json

import __spark_entry__


def test_entry_and_queries(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "output_type" in df.columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_reports_round_trip(spark, tmp_path):
    from gridrefs.operators import report as rp
    from gridrefs.sources import writers

    schema = "project_id string, part string, section string, error string, parent string, name string, detail map<string,string>, skipped boolean"
    rows = [("007", "data", "variables", "size_errors", None, "v", {"test": "1"}, False), ("b", "metadata", "attributes", "missing", "global", 't"x', None, True)]
    report = spark.createDataFrame(rows, schema)
    writers.write_report(report, str(tmp_path / "r"))
    got = rp.unnest(writers.read_reports(spark, str(tmp_path / "r"))).select(*report.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr)


def test_nested_attributes(spark):
    from gridrefs.operators import catalog as ct

    df = spark.createDataFrame([("a", '{"x":{"y":1,"z":"q"},"y":[1,2],"remote":false}'), ("b", "{}")], "project_id string, base string")
    get = lambda name, value: [json.loads(r["base"]) for r in ct.set_attribute(df, name, value).orderBy("project_id").collect()]
    assert get("x.y", "True") == [{"x": {"y": True, "z": "q"}, "y": [1, 2], "remote": False}, {"x": {"y": True}}]
    assert get("y", 'a"b') == [{"x": {"y": 1, "z": "q"}, "y": 'a"b', "remote": False}, {"y": 'a"b'}]
    assert get("x.q.r", "None")[0]["x"] == {"y": 1, "z": "q", "q": {"r": None}}


def test_projects_are_added_once(spark):
    from gridrefs.sources.readers import add_projects

    old = spark.createDataFrame([("a", ["/x.nc"])], "project_id string, uris array<string>")
    new = spark.createDataFrame([("a", ["/y.nc"]), ("b", ["/y.nc", "/z.tif"]), ("c", ["/y.csv", "/z.nc"])], "project_id string, uris array<string>")
    assert {r["project_id"]: r["uris"][0] for r in add_projects(old, new).collect()} == {"a": "/x.nc", "b": "/y.nc"}
    assert {r["project_id"]: r["uris"][0] for r in add_projects(old, new, overwrite=True).collect()} == {"a": "/y.nc", "b": "/y.nc"}


def test_sets_and_redo(spark):
    from pyspark.sql import functions as F

    from gridrefs.operators import sets as st
    from gridrefs.operators import status as ss

    sets = spark.createDataFrame([("g", "main", "1", 0), ("g", "main", "2", 1), ("h", "main", "2", 0)], "group_id string, set_id string, project_id string, pos int")
    out = st.transfer(sets, spark.createDataFrame([("1",), ("2",)], "project_id string"), "g", "h")
    assert sorted((r["group_id"], r["project_id"], r["pos"]) for r in out.collect()) == [("g", "2", 1), ("h", "1", 1), ("h", "2", 0)]
    assert [r["project_id"] for r in st.by_index(sets, [1]).collect()] == ["2"]
    log = spark.createDataFrame([("g", "1", 1, "scan", "Failed-x", None, "")], "group_id string, project_id string, line_no long, phase string, status string, ts timestamp, job_id string")
    new = st.redo(log, log, "Redo", F.current_timestamp())
    assert ss.last_status(new).first()["status"] == "Redo" and st.scrub(new, log).count() == 1
