"""Parents of deep hosts."""

from __future__ import annotations

from telescale.llm import url_lists


def test_parents_of_deep_hosts(spark):
    labels = [f"l{i}" for i in range(29)] + ["com"]
    rows = [(i, f"http://{'.'.join(labels)}/x", 5) for i in range(2)]
    captures = spark.createDataFrame(rows, "page_id long, url string, day long")
    deep = [".".join(labels[i:]) for i in range(29)]
    entries = spark.createDataFrame([(f"{i:02}", d, 1, True) for i, d in enumerate(deep)],
                                    "list string, domain string, day long, added boolean")
    got = url_lists.judge(captures, entries).collect()
    assert [r.lists for r in got] == [",".join(f"{i:02}" for i in range(29))] * 2
