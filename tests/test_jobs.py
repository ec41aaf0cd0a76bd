import json
import os

from reviewflow import jobs
from reviewflow.session import scratch_path


def test_clean_prepare_train(spark, tmp_path):
    raw = tmp_path / "raw" / "part=1"
    os.makedirs(raw)
    with open(raw / "a.json", "w") as f:
        for i in range(60):
            rec = {"doc_id": i, "rating": float(1 + i % 5), "title": f"t{i}",
                   "text": ("great sound love it" if i % 5 >= 3 else "broken awful refund") + f" {i}",
                   "always_null": None, "other": "x"}
            f.write(json.dumps(rec) + "\n")
    processed = scratch_path(spark, "t-processed")
    report, metrics = jobs.clean_reviews(spark, str(tmp_path / "raw"), processed,
                                         fields=("doc_id", "rating", "title", "text", "always_null"))
    assert metrics["rows_written"] == 60
    assert "always_null" not in spark.read.parquet(processed).columns   # inferred all-null field dropped
    assert report.first()["outcome"] == "Passed"
    prepared, sample = scratch_path(spark, "t-prepared"), scratch_path(spark, "t-sample")
    jobs.prepare_reviews(spark, processed, prepared, sample, sample_n=20)
    assert spark.read.parquet(sample).count() == 20
    m = jobs.train_classifier(spark, prepared, scratch_path(spark, "t-model"), max_iter=5)
    assert 0.0 <= m["accuracy"] <= 1.0
