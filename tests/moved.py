"""What a finished frame's plan has sent through shuffles."""


def shuffled(df, metric="shuffleRecordsWritten"):
    """The sum of a shuffle metric over the plan of a frame that has been collected."""

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        if name == "ReusedExchangeExec":
            return 0
        own = plan.metrics().apply(metric).value() if name == "ShuffleExchangeExec" else 0
        children = plan.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())
