"""op9: the text that is left when boilerplate lines go."""

import random
import re

import pytest

from popcenter.llm import lines


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_boilerplate_lines_go(spark, threshold):
    rnd = random.Random(6)
    prose = lambda n: " ".join(f"w{rnd.randrange(900)}" for _ in range(n))
    banner, rows, want = "  Cookie \t NOTICE: accept all", [], {}
    for k in range(30):
        first, last = prose(40), prose(40)
        source = None if k % 2 else "h"
        # the same line in other case and spacing goes, wordless lines and the rest stay as they were
        rows.append((k, source, f"{first}\n{banner if k % 4 else banner.upper()}\n \n\n{last}  \ncookie notice: ACCEPT all"))
        want[k] = f"{first}\n \n\n{last}  "
    for k, text in ((100, prose(60) + "\n"), (101, None), (102, ""), (103, banner + "\n" + prose(60))):
        rows.append((k, "other", text))  # rare on this host
        want[k] = text
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
        out = {r["doc_id"]: r for r in lines.line_rules(docs, 10, 0.05).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {d: r["kept_text"] for d, r in out.items()} == want
    for d, _, text in rows:
        assert out[d]["n_lost_words"] == len(re.findall(r"\S+", text or "")) - len(re.findall(r"\S+", want[d] or ""))
        assert out[d]["kept"] == (d < 100 or d in (100, 103))
