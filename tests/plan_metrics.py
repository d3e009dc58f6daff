"""Numbers that Spark's executed plans report, for tests that count files and rows read."""


def nodes(plan):
    """All operators of an executed plan, through adaptive stages."""
    name = plan.nodeName()
    yield plan
    if name.startswith("AdaptiveSparkPlan"):
        yield from nodes(plan.executedPlan())
    elif name.endswith("QueryStage"):
        yield from nodes(plan.plan())
    else:
        children = plan.children()
        for k in range(children.size()):
            yield from nodes(children.apply(k))


def scans(df, column):
    """(files read, rows out) of the file scans of a collected DataFrame that read ``column``."""
    found = []
    for node in nodes(df._jdf.queryExecution().executedPlan()):
        if node.nodeName().startswith("Scan ") and column in node.output().toString():
            metrics = node.metrics()
            found.append(tuple(metrics.get(m).get().value() for m in ("numFiles", "numOutputRows")))
    return found
