import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wickline.schemas import RAW  # noqa: E402
from wickline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "wickline-tests")
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return session


@pytest.fixture(scope="session")
def candles(spark):
    """Build raw candles plus symbol from short rows, shuffled over several partitions."""

    def build(rows, symbol="BTCUSDT", step_us=1_000_000, partitions=5):
        """``rows``: dicts with any candle columns; the rest gets defaults."""
        from pyspark.sql import functions as F

        full = []
        for i, row in enumerate(rows):
            base = {c: 1 if t in ("bigint",) else 1.0 for c, t in _types()}
            base.update(open_time=i * step_us, symbol=symbol)
            base.update(row)
            full.append(base)
        random.Random(7).shuffle(full)
        names = [*RAW.names, "symbol"] + [c for c in rows[0] if c not in (*RAW.names, "symbol")]
        kinds = dict(_types()) | {"symbol": "string", "ingestion_date": "date", "date": "date"}
        schema = ", ".join(f"{c} {kinds[c]}" for c in names)
        df = spark.createDataFrame([tuple(r[c] for c in names) for r in full], schema)
        return df.repartition(partitions, F.rand(3))

    return build


def _types():
    return [(f.name, f.dataType.simpleString()) for f in RAW.fields]


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def rows_of():
    return as_set


