import json

import pandas as pd
import pytest

from zephyrgrid import cli


@pytest.fixture()
def store(spark, tmp_path):
    frame = pd.DataFrame({"cell": 1, "fi": 0, "fj": 0, "lat": 10.0, "ord": range(730)})
    frame["doy"], frame["year"] = frame["ord"] % 365 + 1, 1970 + frame["ord"] // 365
    frame["month"] = ((frame["doy"] - 1) // 31 + 1).clip(upper=12)
    frame["tas"], frame["tasrange"], frame["tasskew"] = 280.0 + frame["ord"] % 7, 10.0, 0.25
    spark.createDataFrame(frame).write.parquet(str(tmp_path / "in"))
    return tmp_path


def test_commands(spark, store, capsys):
    source = str(store / "in")
    assert cli.main(["validate", source, "--variable", "tas", "--min-years", "2"]) == 0
    assert cli.main(["validate", source, "--variable", "tas", "--min-years", "3"]) == 1
    assert cli.main(["derive", source, str(store / "derived")]) == 0
    assert cli.main(["validate-dataset", str(store / "derived")]) == 0
    assert cli.main(["convert", source, str(store / "copy"), "--chunks", "cell=64"]) == 0
    assert cli.main(["pack", source, str(store / "packed"), "--variable", "tas"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["saturated"] == 0
    assert cli.main(["adjust", source, source, source, str(store / "adjusted"), "--variable", "tas"]) == 0
    out = spark.read.parquet(str(store / "adjusted"))
    assert out.count() == 730 and out.where("tas IS NULL").count() == 0
    with pytest.raises(FileExistsError):
        cli.main(["derive", source, str(store / "derived")])
