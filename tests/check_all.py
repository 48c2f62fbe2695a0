"""Run every query at a scale against its SQL: ``python tests/check_all.py <sf_dir> [name ...]``.

``--plain`` uses a session without this library's settings.
"""

import sys
import tempfile
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from pyspark.sql import SparkSession  # noqa: E402

from compare import connect, difference  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from daybook.session import build_session  # noqa: E402


def main(folder: str, names: list[str], plain: bool) -> int:
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if plain:
        builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        for key, value in quiet.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    else:
        scratch = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-check-"), "spark.driver.memory": "8g"}
        spark = build_session("check", "local[8]", 8, **quiet, **scratch)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.monotonic()
        try:
            frame = run(spark, folder)
            verdict = difference(frame, con, oracles[name]) if name in oracles else f"rows only: {frame.count()}"
        except Exception as failure:  # noqa: BLE001
            verdict = "".join(traceback.format_exception_only(failure))[:600]
        ok = verdict is None or verdict.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {time.monotonic() - started:6.2f}s {name} {verdict or ''}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    arguments = [a for a in sys.argv[1:] if a != "--plain"]
    sys.exit(1 if main(arguments[0], arguments[1:], "--plain" in sys.argv) else 0)
