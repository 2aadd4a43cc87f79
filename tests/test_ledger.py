"""The folded ledger holds what its log held, in few files."""

from datetime import datetime, timezone
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from fareflow.sources import ledger
from fareflow.sources.ledger import fold_ledger, one_row, read_ledger, record

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = pa.schema([
    ("path", pa.string()), ("length", pa.int64()), ("modified_at", pa.timestamp("us", "UTC")), ("batch_id", pa.string()),
    ("status", pa.string()), ("error", pa.string()), ("recorded_at", pa.timestamp("us", "UTC")), ("merged_into", pa.string()),
])


def log(root, first, count):
    Path(root).mkdir(exist_ok=True)
    for k in range(first, first + count):
        row = {"path": f"/raw/{k}.csv", "length": k, "batch_id": f"b-{k}", "status": "loaded", "recorded_at": AT}
        pq.write_table(pa.Table.from_pylist([row], SCHEMA), f"{root}/part-{k:06d}.parquet")


def ids(spark, root):
    return sorted(r.batch_id for r in read_ledger(spark, root).select("batch_id").collect())


def test_many_batches_in_few_files(spark, tmp_path):
    root = str(tmp_path / "ledger")
    log(root, 0, 5000)
    assert not fold_ledger(spark, root, least=5001)
    assert fold_ledger(spark, root)
    assert len(read_ledger(spark, root).inputFiles()) <= 4
    assert ids(spark, root) == sorted(f"b-{k}" for k in range(5000))
    record(root, one_row(spark), "b-new", "loaded", AT)
    assert len(ids(spark, root)) == 5001 and len(read_ledger(spark, root).inputFiles()) <= 5


def test_covered_files_go_with_the_next_fold(spark, tmp_path):
    root = str(tmp_path / "ledger")
    log(root, 0, 10)
    early = read_ledger(spark, root)
    assert fold_ledger(spark, root, least=5)
    assert early.count() == 10  # a reader from before still finds its files
    middle = read_ledger(spark, root)
    log(root, 10, 5)
    assert fold_ledger(spark, root, least=5)
    assert len(list(Path(root).glob("part-*"))) == 5 and middle.count() == 10
    assert ids(spark, root) == sorted(f"b-{k}" for k in range(15))
    assert not fold_ledger(spark, root, least=5)
    log(root, 15, 5)
    assert fold_ledger(spark, root, least=5)
    assert ids(spark, root) == sorted(f"b-{k}" for k in range(20))
    assert len(list(Path(root).glob("_folded/*"))) == 2


def test_incomplete_fold_is_not_read(spark, tmp_path):
    root = str(tmp_path / "ledger")
    log(root, 0, 6)
    read_ledger(spark, root).write.parquet(f"{root}/_folded/000000000001/rows")
    assert len(ids(spark, root)) == 6
    assert fold_ledger(spark, root, least=5) and len(ids(spark, root)) == 6


def test_folding_is_off_for_short_ledgers(spark, tmp_path):
    root = str(tmp_path / "ledger")
    assert not fold_ledger(spark, root) and read_ledger(spark, root).isEmpty()
    log(root, 0, ledger.FOLD_AT - 1)
    assert not fold_ledger(spark, root)
