"""The command line, from a raw landing folder to bars, thresholds and the log."""

import json

from helpers import START, tick, write_files

from tickspan.jobs import main
from tickspan.plans.store import Store


def test_raw_feed_to_thresholds(spark, tmp_path):
    raw = [
        json.dumps(json.loads(tick(code, 100.0 + 10 * (i % 2), 60 * i)) | {"type": "trade", "n": i})
        for i in range(6)
        for code in ("A", "B", "UNWANTED")
    ]
    write_files(str(tmp_path / "landing"), [raw])
    main(
        ["ingest", "--from", f"text:{tmp_path}/landing", "--to", f"parquet:{tmp_path}/ticks"]
        + ["--checkpoint", f"{tmp_path}/cp1", "--once", "--symbols", "A", "B"]
    )
    messages = spark.read.parquet(f"{tmp_path}/ticks")
    assert messages.count() == 12
    assert {bytes(r.key) for r in messages.collect()} == {b"A", b"B"}

    main(
        ["bars", "--from", f"parquet:{tmp_path}/ticks", "--store", f"{tmp_path}/store", "--once"]
        + ["--checkpoint", f"{tmp_path}/cp2", "--state-partitions", "2"]
        + ["--rejects", f"{tmp_path}/rejects"]
    )
    store = Store(f"{tmp_path}/store")
    assert store.ohlcv.current(spark).count() == 12
    assert store.anomaly_log.current(spark).count() == 10  # default threshold, moves of ten percent
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"

    main(
        ["quarantine", "--from", f"parquet:{tmp_path}/ticks", "--to", f"{tmp_path}/bad", "--once"]
        + ["--checkpoint", f"{tmp_path}/cp3"]
    )
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 0

    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 0
    before = sorted(store.ohlcv.current(spark).collect())
    main(["close-days", "--store", f"{tmp_path}/store", "--until", "2024-01-01"])
    assert sorted(store.ohlcv.current(spark).collect()) == before

    as_of = START.replace(day=2)
    main(["thresholds", "--store", f"{tmp_path}/store", "--as-of", str(as_of)])
    found = store.anomaly_threshold.current(spark).collect()
    assert sorted(r.code for r in found) == ["A", "B"]
    assert {r.calculated_at for r in found} == {as_of}

    main(["thresholds", "--store", f"{tmp_path}/store", "--as-of", str(as_of), "--from-days"])
    again = store.anomaly_threshold.current(spark).collect()
    assert sorted(r.code for r in again) == ["A", "B"]
    main(["alerts", "--store", f"{tmp_path}/store", "--to", f"{tmp_path}/alerts", "--once"]
         + ["--checkpoint", f"{tmp_path}/cp4"])
    assert spark.read.parquet(f"{tmp_path}/alerts").count() == 10
    main(["open-bars", "--checkpoint", f"{tmp_path}/cp2", "--to", f"{tmp_path}/open"])
    assert spark.read.parquet(f"{tmp_path}/open").count() >= 2
    main(["panel", "--store", f"{tmp_path}/store", "anomalies"])
