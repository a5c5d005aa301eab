"""Helpers that several test modules import."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
