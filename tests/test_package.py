"""The package away from its own folder."""

import os
import subprocess
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

from tidemill.session import FREE_SHUFFLES, cut

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from tidemill.session import get_session
from tidemill.sources.cards import card_text
spark = get_session("away", "local[2]", **{{"spark.ui.enabled": "false"}})
page = "<div class='card'><h3>Acme</h3><p>A company that makes rockets and anvils</p></div>" * 3
pages = spark.createDataFrame([("http://s", 1, "http://s?page=1", page)], "start_url string, page_num int, url string, html string")
print("ROWS", card_text(pages).count())
"""


def test_workers_find_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_cut_frees_its_shuffles(spark):
    """Shuffle files go when the rows are written, not when the driver collects its garbage; a session that sets the way itself keeps it."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in files.getAllFiles().mkString(" ").split() if "/shuffle_" in f and f.endswith(".data")}

    def left_by_cut():
        before, stop = shuffled(), time.time() + 10
        rows = cut(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count())
        while (left := shuffled() - before) and time.time() < stop:
            time.sleep(0.2)
        assert rows.count() == 7
        return left

    assert not left_by_cut() and spark.conf.get(FREE_SHUFFLES, None) is None
    try:
        spark.conf.set(FREE_SHUFFLES, "false")
        assert left_by_cut() and spark.conf.get(FREE_SHUFFLES) == "false"
    finally:
        spark.conf.unset(FREE_SHUFFLES)
