"""The three scheduled jobs through the command line (in-process)."""
import json
import os
import tempfile

from velocube import cli
from tests.conftest import SF0001


def test_cli_jobs(spark, capsys):
    root = tempfile.mkdtemp(prefix="velocube-cli-")
    ev = f"{SF0001}/events.parquet"
    p = lambda *parts: os.path.join(root, *parts)
    cli.main(["features", "--format", "events", "--trips", ev, "--features", p("f"), "--report", p("stats")])
    feats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert feats["rows"] > 0 and feats["report_month"] == "202401"
    cli.main(["train", "--features", p("f"), "--runs", p("runs"), "--models", p("models"), "--rounds", "3"])
    rec = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rec["promotion_status"] == "Promoted" and rec["n_features"] == 33
    cli.main(["infer", "--features", p("f"), "--runs", p("runs"), "--out", p("pred"), "--as-of", "2024-02-05 10:00:00"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"] == 72
    cli.main(["features", "--format", "events", "--trips", ev, "--features", p("g"), "--months", "1",
              "--as-of", "2024-01-20"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"] == "no data"
