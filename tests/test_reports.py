"""The whole original batch run from one JSON file of items."""

import json
import os

from trendlake.plans.reports import write_reports
from trendlake.sources import io


def test_write_reports_end_to_end(spark, scratch):
    items = []
    for i in range(60):
        items.append({"id": i, "name": f"repo{i}", "full_name": f"o/repo{i}",
                      "language": [None, "Python", "JavaScript", "Go"][i % 4], "stars": 400 + 13 * i,
                      "forks": i % 9, "open_issues": i % 5, "created_at": f"{2021 + i % 4}-0{1 + i % 9}-15T00:00:00Z",
                      "updated_at": "2024-06-01T00:00:00Z", "description": f"tool number {i}",
                      "topics": [["ai", "web"], ["web"], [], ["blockchain", "ai"]][i % 4], "html_url": None})
    path = os.path.join(scratch, "items.json")
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(items, fh)
    metrics = {r.output: r.row_count for r in
               write_reports(spark, path, scratch, as_of="2025-01-01 00:00:00").collect()}
    assert metrics["rdd_language_stars"] == 3
    assert metrics["processed_language_year"] == sum(1 for _ in {(x["language"], x["created_at"][:4])
                                                                  for x in items if x["language"]})
    assert metrics["feature_engineering"] == 45
    assert metrics["trends"] == 3 and metrics["language_comparison"] == 2
    assert metrics["data_quality_report"] == 1 and metrics["graph_metrics"] > 60
    assert metrics["nlp_topic_clusters"] == 60
    growth = io.read_result(spark, os.path.join(scratch, "output", "growth"))
    assert growth.count() == metrics["growth"]
    quality = spark.read.json(os.path.join(scratch, "output", "data_quality_report")).first()
    assert quality.row_count == 60 and quality.null_language_pct == 25.0
    assert sorted(quality.schema_extra_columns) == ["description", "open_issues", "updated_at"]


def test_command_line(spark, scratch, capsys):
    from trendlake.__main__ import main
    path = os.path.join(scratch, "items.json")
    with open(path, "w", encoding="utf-8") as fh:
        json.dump([{"id": i, "language": "Go" if i % 2 else "Rust", "stars": 10 * i,
                    "created_at": f"{2020 + i % 3}-01-01T00:00:00Z"} for i in range(12)], fh)
    main([path, scratch, "--only", "growth", "avg_stars"])
    out = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert out == {"growth": "6", "avg_stars": "2"}
