from __future__ import annotations

from collections import Counter

FCD_HEADER = (
    "timestep_time;vehicle_angle;vehicle_id;vehicle_lane;vehicle_pos;vehicle_slope;"
    "vehicle_speed;vehicle_type;vehicle_x;vehicle_y"
)


def bag(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())


def plan(df) -> str:
    """The physical plan as Spark prints it."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def write_lines(path, *lines) -> str:
    path.write_text("\n".join(lines) + "\n")
    return str(path)
