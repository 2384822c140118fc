"""The grid's scores are added up where a document's terms lie, and equal what a plain sum gives for ids without terms."""
import re

from corpusflow.operators import models as md


def test_scores_are_not_shuffled_by_cell(spark):
    cells = [(i, f"f{j}", 1.0 + (i * j) % 5) for i in range(60) for j in range(8) if i < 50 and (i + j) % 3]
    matrix = spark.createDataFrame(cells, "doc_id long, feature string, value double")
    labels = spark.createDataFrame([(i, i % 3) for i in range(60)], "doc_id long, class_id long")
    found = md.nb_grid_cv(matrix, labels, [2, 5], [0.5, 1.0])
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", found._jdf.queryExecution().toString())
    assert keys and not [k for k in keys if "doc_id" in k and ("selector" in k or "bucket" in k)]
    rows = found.collect()
    assert len(rows) == 2 * 2 * 2 * 2 and all(0 < r.cv_accuracy <= 1 for r in rows)
