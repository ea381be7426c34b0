"""Small-frame helpers."""


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def one(df, cond, *cols):
    got = df.filter(cond).select(*cols).collect()
    assert len(got) == 1, got
    return tuple(got[0]) if len(cols) > 1 else got[0][0]


def approx(a, b, tol=1e-9):
    return a is not None and abs(a - b) <= tol * max(1.0, abs(b))
