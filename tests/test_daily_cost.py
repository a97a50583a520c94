"""Rows that the daily run shuffles, from Spark's event log."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
RUN = """
import sys
import __spark_entry__ as contract
from marketbars.plans.daily import run_forecast, run_ingest, run_publish
from marketbars.session import local_session

spark = local_session("cost", 4)
cfg = contract._settings(spark, train_days=None)
run_ingest(spark, contract._incoming(spark, sys.argv[1]), cfg)
run_forecast(spark, cfg)
run_publish(spark, cfg, contract.FIRST_RUN)
spark.stop()
"""


def test_shuffled_rows_of_the_daily_run(tmp_path):
    """At most eight times the keys: at sf0.01, 3,982 keys of 9,828 staged rows."""
    options = {"enabled": "true", "dir": f"file://{tmp_path}", "compress": "false", "rolling.enabled": "false"}
    submit = " ".join(f"--conf spark.eventLog.{k}={v}" for k, v in options.items()) + " pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": submit, "PYTHONPATH": str(ROOT)}
    subprocess.run([sys.executable, "-c", RUN, "/root/testdata/sf0.01"], env=env, check=True, timeout=300,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    written = 0
    for line in next(tmp_path.iterdir()).read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            metrics = event.get("Task Metrics") or {}
            written += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
    assert 0 < written < 8 * 3982, written
