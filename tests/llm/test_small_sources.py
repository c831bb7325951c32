"""Sources of a mixture that hold less than a block in each shard."""

import random

import pytest

from loomset.llm import mix

TARGET = "source string, target_share double, max_repeats int"
DOC = "doc_id bigint, source string, text string"


@pytest.mark.parametrize(("n", "repeats"), [(150, 1), (150, 3), (9, 1)])
def test_small_source_is_used_up(spark, n, repeats):
    r = random.Random(7)
    text = lambda k: " ".join(r.choice(["river", "lamp", "coin", "boat"]) for _ in range(k))
    docs = [(k, "small", text(20)) for k in range(n)] + [(1000 + k, "large", text(100)) for k in range(3000)]
    m = mix.Mixture(spark.createDataFrame(docs, DOC), spark.createDataFrame([("small", 0.05, repeats), ("large", 0.95, 1)], TARGET))
    s = {x.source: x for x in m.shares().collect()}
    assert s["small"].mixed_tokens >= 0.9 * repeats * s["small"].available_tokens and s["small"].most_repeats == repeats
    assert abs(s["small"].actual_share - 0.05) < 0.01 and s["large"].most_repeats == 1


def test_less_than_a_block_is_refused(spark):
    d = spark.createDataFrame([(1, "a", "words"), (2, "b", "words " * 1000)], DOC)
    with pytest.raises(ValueError, match="one block"):
        mix.Mixture(d, spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], TARGET))
