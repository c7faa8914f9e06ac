import datetime as dt
import json

import pytest

from tickengine import cli
from tickengine.operators.quality import DataQualityError
from tickengine.session import new_dir
from tickengine.sources import tables


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Messages of two tickers, taken in by the stream job."""
    folder = tmp_path_factory.mktemp("messages")
    lines = [
        json.dumps({"ticker": t, "price": 1.0 + i, "volume": 1, "timestamp": f"2024-06-03T10:{i:02d}:00"})
        for i in range(20) for t in ("AAPL", "MSFT")
    ]
    (folder / "a.txt").write_text("\n".join([*lines, "broken"]))
    root = new_dir(spark, "lake")
    cli.main(["stream", "--source", str(folder), "--tables", root, "--checkpoints", f"{root}/cp",
              "--once", "--high-low", "--window", "5 minutes"])
    return str(folder), root


def test_stream(spark, lake):
    _, root = lake
    assert tables.read_table(spark, f"{root}/raw").count() == 40
    assert tables.read_table(spark, f"{root}/quarantine").count() == 1
    assert "price_high_5m" in tables.read_table(spark, f"{root}/vwap_5m").columns


def test_backfill(spark, lake):
    folder, _ = lake
    out = new_dir(spark, "dump")
    cli.main(["backfill", "--source", folder, "--out", out, "--checkpoints", new_dir(spark, "cp")])
    assert spark.read.text(out).count() == 41  # the broken one too


def test_check(spark, lake):
    _, root = lake
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    # the ticks arrived now, but their event times are long ago: fresh, yet not covered
    with pytest.raises(DataQualityError, match="no recent ticks"):
        cli.main(["check", "--tables", root, "--as-of", now])
    with pytest.raises(DataQualityError, match="stale"):
        cli.main(["check", "--tables", root, "--as-of", "2100-01-01 00:00:00"])
    cli.main(["check", "--tables", root, "--as-of", now, "--days", "100000", "--lookback",
              "1000000 hours", "--ticker", "AAPL", "MSFT"])
    with pytest.raises(DataQualityError, match="JPM"):
        cli.main(["check", "--tables", root, "--as-of", now, "--days", "100000"])


def test_maintain(spark, lake, capfd):
    _, root = lake
    before = tables.read_table(spark, f"{root}/vwap_5m").count()
    cli.main(["maintain", "--tables", root, "--window", "5 minutes"])
    assert "raw" in capfd.readouterr().out
    assert tables.read_table(spark, f"{root}/raw").count() == 40
    assert tables.read_table(spark, f"{root}/vwap_5m").count() == before
    cli.main(["maintain", "--tables", root, "--window", "5 minutes", "--keep-hours", "168"])
    assert tables.read_table(spark, f"{root}/raw").count() == 40  # listed only
    cli.main(["maintain", "--tables", root, "--window", "5 minutes", "--keep-hours", "168", "--delete"])
    assert tables.stored_rows(spark, f"{root}/raw") is None
