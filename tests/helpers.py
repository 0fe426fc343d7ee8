import json
import os

from pyspark.sql import functions as F

from tidemark.plans.settings import Paths
from tidemark.schemas import series_dimension

SERIES = [("daily_rate", 11, "daily"), ("monthly_index", 433, "monthly"), ("currency", 1, "daily")]


def three_series(spark, **signed):
    return series_dimension(spark, [(*row, signed.get(row[0], False)) for row in SERIES])


def land(root, batch_ref, payloads):
    """Write one JSON document per series: {code: [(date, value), …] or raw text}."""
    for code, rows in payloads.items():
        folder = f"{root}/batch_ref={batch_ref}/series_code={code}"
        os.makedirs(folder, exist_ok=True)
        text = rows
        if not isinstance(rows, str):
            text = json.dumps([{"data": day, "valor": value} for day, value in rows])
        with open(f"{folder}/payload.json", "w") as out:
            out.write(text)


def paths(tmp_path):
    return Paths(str(tmp_path / "tables"), str(tmp_path / "landing"))


def null_last(row):
    return [(v is None, str(v)) for v in row]


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=null_last)


def files_under(folder):
    """Data files of a table with their times, to see what a write replaced."""
    found = {}
    for root, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(root, name)
                found[os.path.relpath(path, folder)] = os.stat(path).st_mtime_ns
    return found


def check(report, name, series=None):
    picked = report.filter(F.col("check_name") == name)
    if series is not None:
        picked = picked.filter(F.col("series_name") == series)
    return picked.first()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
