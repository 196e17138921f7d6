import os
import tempfile
import uuid

from medstar.operators.wide_table import WideTable
from medstar.session import scratch_path
from medstar.streaming.ingest_stream import start_ingest
from tests.docs import inpatient


def _write(d, name, key):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(inpatient(ids=(f'<id root="2.1" extension="{key}"/>',)))


def test_incremental_ingest_exactly_once(spark):
    d = tempfile.mkdtemp(prefix="medstar-stream-")
    table = f"emr_{uuid.uuid4().hex[:8]}"
    ckpt = scratch_path(spark, "stream-ckpt")
    _write(d, "a.xml", "RN32_001")
    _write(d, "b.xml", "RN32_002")
    start_ingest(spark, d, table, checkpoint=ckpt).awaitTermination()
    _write(d, "c.xml", "RN32_003")
    start_ingest(spark, d, table, checkpoint=ckpt).awaitTermination()
    start_ingest(spark, d, table, checkpoint=ckpt).awaitTermination()   # nothing new
    wt = WideTable.open(spark, table)
    assert wt.families["specific"] == ["title", "languageCode", "content"]
    keys = sorted(r["row_key"] for r in wt.latest(["specific:title"]).collect())
    assert keys == ["RN32_001", "RN32_002", "RN32_003"]
    assert wt.log().count() == 3 and len(wt.batches()) == 2


def _stream(spark, d, table, ckpt, **options):
    start_ingest(spark, d, table, checkpoint=ckpt, **options).awaitTermination()


def _keys(spark, table):
    return sorted(r["row_key"] for r in WideTable.open(spark, table).scan(["specific:title"]).collect())


def test_stream_compact_stream(spark, tmp_path):
    d, table = str(tmp_path), f"emr_{uuid.uuid4().hex[:8]}"
    ckpt = scratch_path(spark, "stream-ckpt")
    _write(d, "a.xml", "RN32_001")
    _stream(spark, d, table, ckpt)
    _write(d, "b", "RN32_002")                    # any name counts
    _stream(spark, d, table, ckpt)
    assert WideTable.open(spark, table).maintain(1)
    os.makedirs(f"{d}/deeper")
    _write(f"{d}/deeper", "c.XML", "RN32_003")
    _stream(spark, d, table, ckpt)
    assert _keys(spark, table) == ["RN32_001", "RN32_002", "RN32_003"]


def test_two_streams_into_one_table(spark, tmp_path):
    table = f"emr_{uuid.uuid4().hex[:8]}"
    for i in (1, 2):
        os.makedirs(f"{tmp_path}/{i}")
        _write(f"{tmp_path}/{i}", "a.xml", f"RN32_00{i}")
        _stream(spark, f"{tmp_path}/{i}", table, scratch_path(spark, "stream-ckpt"))
    assert _keys(spark, table) == ["RN32_001", "RN32_002"]


def test_stream_keeps_rejects_and_bounds_batches(spark, tmp_path):
    table = f"emr_{uuid.uuid4().hex[:8]}"
    for i in range(3):
        _write(str(tmp_path), f"{i}.xml", f"RN32_00{i}")
    (tmp_path / "bad.txt").write_text("<broken")
    _stream(spark, str(tmp_path), table, scratch_path(spark, "stream-ckpt"), max_files_per_trigger=2)
    assert len(WideTable.open(spark, table).batches()) == 2 and len(_keys(spark, table)) == 3
    assert [r["path"].rsplit("/", 1)[1] for r in spark.table(f"{table}_rejects").collect()] == ["bad.txt"]
