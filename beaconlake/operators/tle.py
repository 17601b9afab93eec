"""Satellite element sets: three-line text blocks to rows, and their numeric fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions import strict
from beaconlake.operators.feeds import LINEAGE

# Name parts that mark a satellite of interest.
INTEL_KEYWORDS = (
    "YAOGAN", "COSMOS 2", "WORLDVIEW", "SENTINEL", "SKYSAT", "GEOEYE", "RADARSAT", "LUSAIL", "OFK",
    "EROS", "PRAETORIAN",
)


def extract(payloads: DataFrame) -> DataFrame:
    """Blocks of name, line 1 and line 2.

    Blank lines are ignored; a stray line shifts the blocks after it; a block is kept
    only if its second line starts with 1 and its third with 2.
    """
    lines = F.filter(F.transform(F.split("payload", "\r?\n"), strict.strip), lambda line: line != "")
    split = payloads.select("source", "seq", "fetched_at", F.explode(F.array(lines)).alias("lines"))
    starts = F.when(F.size("lines") >= 3, F.sequence(F.lit(0), F.size("lines") - 3, F.lit(3)))
    blocks = split.select("source", "seq", "fetched_at", "lines", F.posexplode(starts).alias("pos", "start")).select(
        *LINEAGE,
        F.get("lines", F.col("start")).alias("object_name"),
        F.get("lines", F.col("start") + 1).alias("tle_line1"),
        F.get("lines", F.col("start") + 2).alias("tle_line2"),
    )
    return blocks.where(F.col("tle_line1").startswith("1") & F.col("tle_line2").startswith("2")).select(
        *LINEAGE, "object_name", object_id(F.col("tle_line1")).alias("object_id"), "tle_line1", "tle_line2"
    )


def object_id(line1: Column) -> Column:
    return F.when(F.length(line1) >= 7, strict.strip(F.substring(line1, 3, 5))).otherwise("Unknown")


def intel_satellites(*element_sets: DataFrame) -> DataFrame:
    """Element sets of several feeds whose upper-cased name contains a keyword; duplicates stay."""
    combined = element_sets[0]
    for more in element_sets[1:]:
        combined = combined.unionByName(more)
    name = F.upper("object_name")
    hit = F.lit(False)
    for keyword in INTEL_KEYWORDS:
        hit = hit | name.contains(keyword)
    return combined.dropna(subset=["tle_line1"]).where(hit)


def _decimal(line: Column, start: int, length: int) -> Column:
    return F.trim(F.substring(line, start, length)).try_cast("double")


def _implied_point(line: Column, start: int) -> Column:
    """Fields like ` 28098-4`: sign, five digits after the point, exponent."""
    sign = F.trim(F.substring(line, start, 1))
    digits = F.trim(F.substring(line, start + 1, 5))
    power = F.trim(F.substring(line, start + 6, 2))
    return F.concat(sign, F.lit("0."), digits, F.lit("e"), power).try_cast("double")


def _checksum_ok(line: Column) -> Column:
    """The last digit is the sum of all digits, a minus counting one, modulo ten."""
    body = F.substring(line, 1, 68)
    total = F.lit(0)
    for digit in range(1, 10):
        total = total + digit * (F.length(body) - F.length(F.replace(body, F.lit(str(digit)), F.lit(""))))
    total = total + F.length(body) - F.length(F.replace(body, F.lit("-"), F.lit("")))
    return F.substring(line, 69, 1) == (total % 10).cast("string")


def elements(element_sets: DataFrame) -> DataFrame:
    """Add the orbital elements by their fixed columns.

    `epoch_day` is days since 2000-01-01 00:00; years 57 to 99 belong to the last century.
    `usable` is false if a line is misformed; such elements must not be propagated.
    """
    line1, line2 = F.col("tle_line1"), F.col("tle_line2")
    year = F.trim(F.substring(line1, 19, 2)).try_cast("int")
    full_year = year + F.when(year < 57, 2000).otherwise(1900)
    day_of_year = _decimal(line1, 21, 12)
    new_year = F.datediff(F.concat(full_year.cast("string"), F.lit("-01-01")).try_cast("date"), F.lit("2000-01-01").cast("date"))
    out = element_sets.withColumns(
        {
            "norad_id": F.trim(F.substring(line1, 3, 5)).try_cast("int"),
            "epoch_year": full_year,
            "epoch_day_of_year": day_of_year,
            "epoch_day": new_year + day_of_year - 1.0,
            "bstar": _implied_point(line1, 54),
            "inclination_deg": _decimal(line2, 9, 8),
            "raan_deg": _decimal(line2, 18, 8),
            "eccentricity": F.concat(F.lit("0."), F.trim(F.substring(line2, 27, 7))).try_cast("double"),
            "arg_perigee_deg": _decimal(line2, 35, 8),
            "mean_anomaly_deg": _decimal(line2, 44, 8),
            "mean_motion": _decimal(line2, 53, 11),
        }
    )
    numbers = ["epoch_day", "bstar", "inclination_deg", "raan_deg", "eccentricity", "arg_perigee_deg",
               "mean_anomaly_deg", "mean_motion"]
    usable = (F.length(line1) == 69) & (F.length(line2) == 69)
    usable = usable & (F.substring(line1, 3, 5) == F.substring(line2, 3, 5))
    usable = usable & _checksum_ok(line1) & _checksum_ok(line2)
    for name in numbers:
        usable = usable & F.col(name).isNotNull()
    return out.withColumn("usable", F.coalesce(usable & (F.col("mean_motion") > 0), F.lit(False)))
