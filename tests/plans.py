"""Reading query plans."""

import contextlib


def executed(df):
    """The physical plan, before execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def adapted(df):
    """The physical plan as it ended up after running."""
    df.collect()
    return executed(df).split("== Initial Plan ==")[0]


def rows_read(df):
    """Rows that the scans of a plan gave when it ran just now."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    plan, total, todo = query.executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


@contextlib.contextmanager
def settings(spark, **values):
    """Session settings for a while; ``__`` stands for a dot."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    old = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
