"""Rows and plans of DataFrames, for tests."""


def rows(df, *columns):
    """Rows as sorted tuples; nulls first."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
