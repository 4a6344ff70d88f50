"""What Python workers hold, and the size of the batches they get."""

import pytest

from riskstream.llm import workers

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_only_the_latest_is_held():
    made = []

    def build(source):
        made.append(source)
        return source + ["built"]

    first, second = ["a"], ["a"]
    assert workers.held(first, build) is workers.held(first, build)
    assert workers.held(second, build) == ["a", "built"] and len(made) == 2
    workers.held(first, build)
    assert len(made) == 3 and len(workers._held) == 2


@pytest.mark.parametrize(
    ("set_to", "becomes"),
    [("64m", workers.BATCH_BYTES), ("67108864", workers.BATCH_BYTES), ("1g", workers.BATCH_BYTES), ("4m", 4 << 20), ("1000", 1000), ("2048k", 2 << 20)],
)
def test_batches_get_smaller_but_never_larger(spark, conf, set_to, becomes):
    conf(**{NAME.replace(".", "__"): set_to})
    now = workers.small_batches(spark).conf.get(NAME).rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20}
    assert int(now.rstrip("km")) * units.get(now[-1], 1) == becomes
