"""What executed plans did: files opened and bytes shuffled."""

from contextlib import contextmanager


@contextmanager
def fixed_plans(spark):
    """Plans are not changed while they run, so their nodes keep the figures."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def metric(df, node: str, name: str) -> int:
    """The sum of a metric over all nodes of a kind in the plan of ``df``, run once."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    found = [n for n in _nodes(plan) if n.getClass().getSimpleName() == node]
    return sum(int(n.metrics().apply(name).value()) for n in found)
