from __future__ import annotations

import json

from orderlayers.__main__ import main
from orderlayers.queries.registry import _order_files
from orderlayers.sources import read_orders


def test_commands(spark, small, base, tmp_path, capsys):
    files = _order_files(spark, small, files=2)
    main(["load", files, base, "--run-id", "r1"])
    ingested, elt = json.loads(capsys.readouterr().out)
    assert ingested["rows_read"] == elt["rows_read"] == 1500
    main(["elt", base, "--run-id", "r2", "--only-runs", "r1"])
    assert json.loads(capsys.readouterr().out)["inserted_count"] == 0
    main(["elt", base, "--run-id", "r3", "--keep"])
    assert json.loads(capsys.readouterr().out)["unchanged_count"] == 1385
    main(["drop-old", base])
    assert {layer: len(names) for layer, names in json.loads(capsys.readouterr().out).items()} == {
        "orders_validated": 2, "orders_quarantine": 2,
    }
    main(["report", base])
    assert "pyspark_elt" in capsys.readouterr().out
    main(["preview", base])
    assert "orders_quarantine" in capsys.readouterr().out
    main(["inventory", files])
    assert "python_batch" in capsys.readouterr().out
    main(["sample", files, str(tmp_path / "sample"), "--rows", "10"])
    assert read_orders(spark, str(tmp_path / "sample")).count() == 10
    main(["reset", base])
    main(["elt", base])
    assert capsys.readouterr().out == ""
