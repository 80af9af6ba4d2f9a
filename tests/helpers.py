def rows(df, *columns):
    selected = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in selected.collect()), key=repr)


def plan(df):
    """The executed plan as text, before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()


def value(spark, expression):
    return spark.range(1).select(expression).first()[0]
