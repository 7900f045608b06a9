"""Small inputs for tests."""

import json
import os
from datetime import datetime, timedelta

from tickspan.schemas import BAR

START = datetime(2024, 1, 1)
EPOCH_MS = 1704067200000


def at(seconds):
    return START + timedelta(seconds=seconds)


def tick(code, price, second, volume=1.0):
    """One JSON tick; a second of None leaves its time out."""
    millis = None if second is None else EPOCH_MS + int(second * 1000)
    return json.dumps(
        {
            "code": code,
            "trade_price": price,
            "trade_volume": volume,
            "timestamp": millis,
            "ask_bid": "ASK",
        }
    )


def write_files(folder, files, first=0):
    """One text file per list of lines, their modification times in order."""
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(files, start=first):
        path = os.path.join(folder, f"{i:04}.txt")
        with open(path, "w", encoding="utf-8") as f:
            f.write("\n".join(lines))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def bar(code, minute, close, **other):
    values = {
        "open": close,
        "high": close,
        "low": close,
        "close": close,
        "volume": 1.0,
        "trade_count": 1,
    } | other
    start = START + timedelta(minutes=minute)
    return (code, start, start + timedelta(minutes=1), *values.values())


def bars_frame(spark, rows):
    return spark.createDataFrame(rows, BAR)
