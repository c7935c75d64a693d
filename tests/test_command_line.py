from __future__ import annotations

from datetime import date

import pytest

import sample_data
from footfall import Targets
from footfall.__main__ import main

SF_DIR = "/root/testdata/sf0.001"


def test_load_and_run(spark, tmp_path, capsys):
    raw, made = tmp_path / "raw", Targets(str(tmp_path / "made"))
    for name in ("events", "orders", "order_items"):
        typed = sample_data.read(spark, SF_DIR, sample_data.RAW[name])
        csv = str(tmp_path / f"{name}.csv")
        sample_data.write_csv(typed, csv)
        main(["load", name, csv, str(raw / name), "--load-ts", "2024-02-01T00:00:00"])
    assert "events: 0 rows rejected" in capsys.readouterr().out
    for day in ("2024-01-29", "2024-01-30"):
        main(["run", str(raw), made.base, "--day", day])
    features = made.read(spark, "behavior_features")
    assert len(features.columns) == 41
    last = features.agg({"last_event_time": "max"}).head()[0]
    assert last.date() == date(2024, 1, 30)
    history = made.read(spark, "orders_snapshot")
    assert dict(history.dtypes)["valid_to"] == "timestamp_ntz"
    assert history.where("valid_to is not null").isEmpty()  # the same source both days


@pytest.mark.parametrize(
    "options",
    [
        [],
        ["--start", "2024-01-01"],
        ["--day", "2024-01-01", "--end", "2024-01-02"],
        ["--day", "2024-01-01", "--steps", "nonsense"],
    ],
)
def test_refused_options(tmp_path, options):
    with pytest.raises(SystemExit):
        main(["run", str(tmp_path), str(tmp_path), *options])
