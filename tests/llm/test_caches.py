"""What one operator keeps in Python workers goes when another begins."""

import numpy as np
import pyarrow as pa

from metascope.llm import quality
from metascope.llm.common import process_cache


def test_grading_frees_what_packing_kept(spark):
    def fill(batches):
        process_cache("tokenizers")["large"] = b"x"
        yield from batches

    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array([bool(process_cache("tokenizers").get("large"))] * batch.num_rows))

    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string").coalesce(1)
    model = quality.OrdinalModel(np.zeros(quality.FEATURES), np.zeros(1))
    assert docs.mapInArrow(fill, docs.schema).count() == 1
    assert docs.mapInArrow(kept, docs.schema).count() == 1
    assert quality.grade_quality(docs, model).count() == 1
    assert quality.grade_quality(docs, model).filter("tail_prob >= 0").count() == 1
    assert docs.mapInArrow(kept, docs.schema).count() == 0
