"""The streamed last status equals the batch one."""

from gridrefs.operators.status import last_status
from gridrefs.queries.derive import status_log
from gridrefs.streaming import status as stream

DATA = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    log = status_log(spark, DATA)
    log.repartitionByRange(6, "line_no").write.parquet(str(tmp_path / "log"))
    lines = stream.read_log_stream(spark, str(tmp_path / "log"), files_per_trigger=2)
    path = str(tmp_path / "followed")
    stream.follow(lines, str(tmp_path / "cp"), path).awaitTermination(120)
    key = lambda df: sorted((r["group_id"], r["project_id"], r["phase"], r["status"]) for r in df.collect())
    assert key(stream.followed(spark, path)) == key(last_status(log))
    assert stream.current(spark, path).where("status = 'Pending'").count() == 0
    stream.compact(spark, path, str(tmp_path / "compact"))
    assert key(stream.followed(spark, str(tmp_path / "compact"))) == key(last_status(log))
