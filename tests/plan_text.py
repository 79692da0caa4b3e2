"""Text of a plan, for tests of its shape."""


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
