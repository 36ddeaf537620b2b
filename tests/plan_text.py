"""Readers of physical plans; test support only."""


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan after the frame itself has run, with what adaptive execution changed."""
    df.rdd.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def count(plan: str, node: str) -> int:
    return sum(line.lstrip(" :+-*()0123456789").startswith(node) for line in plan.splitlines())


def _nodes(plan):
    """A physical plan's nodes, through what adaptive execution wraps around stages."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
    else:
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from _nodes(children.apply(i))


def shuffle_records(df) -> list[int]:
    """Records written by every shuffle of a frame that has run."""
    out = []
    for node in _nodes(df._jdf.queryExecution().executedPlan()):
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            out.append(int(node.metrics().apply("shuffleRecordsWritten").value()))
    return out


def files_read(df) -> int:
    """Files that the scans of a frame that has run have opened."""
    return sum(int(n.metrics().apply("numFiles").value()) for n in _nodes(df._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "FileSourceScanExec")
