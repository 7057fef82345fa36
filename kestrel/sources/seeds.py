"""Static lookup seeds.

ELPI cut scores: 11 grade bands × 4 level codes (44 rows, fixed size), the scale-score range
that subdivides Levels 2 and 3.  Ranges are integer-inclusive with gaps between bands, so a
fractional score can fall in none.  Small and bounded: joined with a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CUT_SCORE_SCHEMA = T.StructType([
    T.StructField("grade_band", T.StringType()),
    T.StructField("level_code", T.StringType()),
    T.StructField("min_score", T.LongType()),
    T.StructField("max_score", T.LongType()),
])

# fixed values: (grade_band, level_code, min_score, max_score)
ELPI_CUT_SCORES = [
    ("K", "2L", 1374, 1397), ("K", "2H", 1398, 1421), ("K", "3L", 1422, 1447), ("K", "3H", 1448, 1473),
    ("1", "2L", 1411, 1432), ("1", "2H", 1433, 1454), ("1", "3L", 1455, 1480), ("1", "3H", 1481, 1506),
    ("2", "2L", 1424, 1446), ("2", "2H", 1447, 1470), ("2", "3L", 1471, 1500), ("2", "3H", 1501, 1531),
    ("3", "2L", 1448, 1467), ("3", "2H", 1468, 1487), ("3", "3L", 1488, 1510), ("3", "3H", 1511, 1534),
    ("4", "2L", 1459, 1478), ("4", "2H", 1479, 1498), ("4", "3L", 1499, 1523), ("4", "3H", 1524, 1548),
    ("5", "2L", 1467, 1489), ("5", "2H", 1490, 1513), ("5", "3L", 1514, 1536), ("5", "3H", 1537, 1559),
    ("6", "2L", 1475, 1495), ("6", "2H", 1496, 1516), ("6", "3L", 1517, 1541), ("6", "3H", 1542, 1566),
    ("7", "2L", 1481, 1503), ("7", "2H", 1504, 1526), ("7", "3L", 1527, 1550), ("7", "3H", 1551, 1575),
    ("8", "2L", 1486, 1509), ("8", "2H", 1510, 1533), ("8", "3L", 1534, 1561), ("8", "3H", 1562, 1589),
    ("9-10", "2L", 1493, 1518), ("9-10", "2H", 1519, 1544), ("9-10", "3L", 1545, 1574), ("9-10", "3H", 1575, 1605),
    ("11-12", "2L", 1500, 1526), ("11-12", "2H", 1527, 1554), ("11-12", "3L", 1555, 1584), ("11-12", "3H", 1585, 1614),
]


def cut_scores(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """The cut-score seed, from a header CSV when given, else from the fixed values above."""
    if csv_path:
        return spark.read.option("header", True).schema(CUT_SCORE_SCHEMA).csv(csv_path)
    return spark.createDataFrame(ELPI_CUT_SCORES, CUT_SCORE_SCHEMA)


def seed_values_sql() -> str:
    """The seed as a VALUES list (for SQL oracles)."""
    rows = ", ".join(f"('{b}', '{c}', {lo}, {hi})" for b, c, lo, hi in ELPI_CUT_SCORES)
    return f"SELECT * FROM (VALUES {rows}) AS t(grade_band, level_code, min_score, max_score)"
