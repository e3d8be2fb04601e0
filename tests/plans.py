"""Reading physical plans in tests."""

import re


def planned(df):
    """The plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    """The plan that adaptive execution ended with, also in subqueries; runs the query."""
    df.collect()
    kept, skipped_from = [], None
    for line in planned(df).splitlines():
        column = len(line) - len(line.lstrip(" :|+-"))
        if skipped_from is not None and column < skipped_from:
            skipped_from = None
        if skipped_from is None and "== Initial Plan ==" in line:
            skipped_from = column
        if skipped_from is None:
            kept.append(line)
    return "\n".join(kept)


def count(plan, pattern):
    return len(re.findall(pattern, plan))


class settings:
    """Session settings for the length of a block."""

    def __init__(self, spark, **values):
        self.spark = spark
        self.values = {k.replace("__", "."): v for k, v in values.items()}

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.values}
        for k, v in self.values.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
