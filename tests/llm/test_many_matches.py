"""A text with thousands of secrets takes time in proportion, and every place is right."""

import re
import time

from pyspark.sql import functions as F

from riskloom.llm import secret_scan


def test_a_text_full_of_hashes(spark):
    def rows(n):
        text = " ".join(f"{i:032x}" for i in range(n)) + " token = abcDEF123456789"
        return spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string"), text

    secret_scan.scan_secrets(rows(50)[0]).collect()
    seconds = {}
    for n in (1_000, 8_000):
        df, text = rows(n)
        start = time.perf_counter()
        got = {r["doc_id"]: r for r in secret_scan.scan_secrets(df).collect()}
        seconds[n] = time.perf_counter() - start
        hashes = [f"hex:{m.start()}:{m.end()}" for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
        assert got[1]["n_hex"] == len(hashes) == n and got[1]["n_assign"] == 1
        assert [s for s in got[1]["spans"].split(",") if s.startswith("hex")] == hashes
        assert got[1][1:] == got[2][1:] and got[3]["n_hex"] == 0
    assert seconds[8_000] < seconds[1_000] + 10
