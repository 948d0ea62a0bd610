"""State lookup seed (S5): code -> full state name.

A fixed 51-row table; as an Arrow table it is rows of the plan, whose number
the planner knows, so joins broadcast it without a count.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quarry.schemas import STATE_CODE

# US state postal codes with upper-case names (50 states
# in order of name, then the District of Columbia).
STATE_CODES: list[tuple[str, str]] = [
    ("AL", "ALABAMA"), ("AK", "ALASKA"), ("AZ", "ARIZONA"), ("AR", "ARKANSAS"),
    ("CA", "CALIFORNIA"), ("CO", "COLORADO"), ("CT", "CONNECTICUT"), ("DE", "DELAWARE"),
    ("FL", "FLORIDA"), ("GA", "GEORGIA"), ("HI", "HAWAII"), ("ID", "IDAHO"),
    ("IL", "ILLINOIS"), ("IN", "INDIANA"), ("IA", "IOWA"), ("KS", "KANSAS"),
    ("KY", "KENTUCKY"), ("LA", "LOUISIANA"), ("ME", "MAINE"), ("MD", "MARYLAND"),
    ("MA", "MASSACHUSETTS"), ("MI", "MICHIGAN"), ("MN", "MINNESOTA"), ("MS", "MISSISSIPPI"),
    ("MO", "MISSOURI"), ("MT", "MONTANA"), ("NE", "NEBRASKA"), ("NV", "NEVADA"),
    ("NH", "NEW HAMPSHIRE"), ("NJ", "NEW JERSEY"), ("NM", "NEW MEXICO"), ("NY", "NEW YORK"),
    ("NC", "NORTH CAROLINA"), ("ND", "NORTH DAKOTA"), ("OH", "OHIO"), ("OK", "OKLAHOMA"),
    ("OR", "OREGON"), ("PA", "PENNSYLVANIA"), ("RI", "RHODE ISLAND"), ("SC", "SOUTH CAROLINA"),
    ("SD", "SOUTH DAKOTA"), ("TN", "TENNESSEE"), ("TX", "TEXAS"), ("UT", "UTAH"),
    ("VT", "VERMONT"), ("VA", "VIRGINIA"), ("WA", "WASHINGTON"), ("WV", "WEST VIRGINIA"),
    ("WI", "WISCONSIN"), ("WY", "WYOMING"), ("DC", "DISTRICT OF COLUMBIA"),
]


def state_codes(spark: SparkSession) -> DataFrame:
    """The built-in lookup as a DataFrame."""
    abbrev, full = zip(*STATE_CODES, strict=True)
    return spark.createDataFrame(pa.table({"state_abbrev": pa.array(abbrev), "state_full": pa.array(full)}), STATE_CODE)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A seed CSV with a header (``state_abbrev,state_full``)."""
    return spark.read.schema(STATE_CODE).option("header", True).csv(path)


def write_seed(df: DataFrame, table: str) -> None:
    """Seed load: replace the lookup table in full."""
    df.write.mode("overwrite").saveAsTable(table)
