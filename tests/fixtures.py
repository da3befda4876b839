"""Hand-written rows of the same shape as the tutorial's inputs (invented values)."""

import datetime as dt

from pyspark.sql import types as T

PLAYERS = [(0, "Ann Alto", [0], 0), (1, "Ben Bass", [1], 1), (2, "Cid Chord", [1, 5], 2),
           (3, "Dee Drum", [3], 3)]
PLAYERS_SCHEMA = "id long, name string, guitars array<long>, band long"
BANDS = [(0, "The Zeros", "Oslo", 1970), (1, "One Way", "Lima", 1981), (3, "Triad", "Kyiv", 1999),
         (4, "Four Winds", "Perth", 2004)]
BANDS_SCHEMA = "id long, name string, hometown string, year long"
GUITARS = [(0, "M0", "Maker A", "Electric"), (5, "M5", "Maker B", "Acoustic"), (1, "M1", "Maker A", "Electric"),
           (2, "M2", "Maker C", "Bass"), (3, "M3", "Maker D", "Electric")]
GUITARS_SCHEMA = "id long, model string, make string, guitarType string"

RATINGS = [("a", 50, 5.0), ("b", None, 7.0), ("c", 70, None), ("d", None, None), ("e", 60, 4.0)]
RATINGS_SCHEMA = "title string, r long, i double"

EMPLOYEES_SCHEMA = T.StructType([
    T.StructField("emp_no", T.IntegerType(), False),
    T.StructField("birth_date", T.DateType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("hire_date", T.DateType()),
])
EMPLOYEES = [
    (1, dt.date(1960, 1, 2), "Ada", "Moss", "F", dt.date(1990, 5, 1)),
    (2, dt.date(1961, 3, 4), "Bo", "Lund", "M", dt.date(1999, 6, 1)),
    (3, dt.date(1962, 5, 6), "Cy", "Park", "F", dt.date(1999, 7, 1)),
    (4, dt.date(1963, 7, 8), "Di", "Reed", "M", dt.date(2001, 1, 9)),
]
