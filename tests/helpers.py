from fleetpulse import schema

NOW_MS = 1_712_345_678_901


def beat(device="pump-7", region="north", status="ok", at=NOW_MS - 1, latency=6.25, cpu=None, mem=None):
    return (device, region, status, at, latency, cpu, mem)


def beats(spark, rows):
    return spark.createDataFrame(rows, schema.HEARTBEAT)


def messages(spark, bodies):
    return spark.createDataFrame([(b,) for b in bodies], "value string")


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
