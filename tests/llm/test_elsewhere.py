from __future__ import annotations

import subprocess
import sys
import textwrap
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]


def test_executors_need_not_have_the_package(tmp_path):
    """Started in another folder, only the driver's path names this one."""
    script = tmp_path / "job.py"
    script.write_text(
        textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(REPO)!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
        import __spark_entry__ as entry
        for name in ("op5_quality_classifier", "op2_decontamination", "op12_fill_in_middle", "op13_filter_audit", "op11_toxicity", "ridge_fit_collinear", "op3_language_id", "op10_packing", "op7_line_dedup"):
            print("rows", name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
        """)
    )
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    rows = {line.split()[1]: int(line.split()[2]) for line in done.stdout.splitlines() if line.startswith("rows")}
    assert done.returncode == 0 and len(rows) == 9 and min(rows.values()) > 0, done.stderr[-2000:]
