"""Regenerate flowlab/plans/rounding.py: the top-level double/float output columns of every
registered query (read from the Spark schemas at sf0.001)."""

import sys

sys.path.insert(0, ".")


def main():
    from pyspark.sql import types as T

    from flowlab.plans import QUERIES
    from flowlab.session import build_session

    spark = build_session()
    out = {}
    for name, fn in sorted(QUERIES.items()):
        df = fn(spark, "/root/testdata/sf0.001")
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
        if cols:
            out[name] = cols
    path = "flowlab/plans/rounding.py"
    text = open(path).read()
    begin, end = text.index("ROUND_COLS = {"), text.index("}\n") + 2
    open(path, "w").write(text[:begin] + "ROUND_COLS = {\n" + "".join(f"    {k!r}: {v!r},\n" for k, v in out.items()) + "}\n" + text[end:])
    spark.stop()


if __name__ == "__main__":
    main()
