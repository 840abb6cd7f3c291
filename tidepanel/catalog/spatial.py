"""Position reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.registry import query
from tidepanel.catalog.series import r9
from tidepanel.functions import spatial
from tidepanel.sources import bindings


@query(
    "bbox_filter",
    """SELECT event_id, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude FROM sn
       WHERE latitude >= 40.0 AND latitude <= 41.0 AND longitude >= -4.0 AND longitude <= -3.0""",
    "sn",
)
def bbox_filter(spark, root):
    """Reports inside a box of one degree around the centre."""
    box = spatial.Settings(box_south=40.0, box_north=41.0, box_west=-4.0, box_east=-3.0)
    sn = bindings.snapshots(spark, root)
    return sn.filter(spatial.in_box(F.col("latitude"), F.col("longitude"), box)).select(
        "event_id", *r9("latitude", "longitude")
    )


@query("haversine", "SELECT event_id, round(distance_nm, 6) AS distance_nm FROM snd", "snd")
def haversine(spark, root):
    return spatial.with_band(bindings.snapshots(spark, root)).select(
        "event_id", F.round("distance_nm", 6).alias("distance_nm")
    )


@query("band_assign", "SELECT event_id, band FROM snb", "snb")
def band_assign(spark, root):
    return spatial.with_band(bindings.snapshots(spark, root)).select("event_id", "band")


def _density_sql() -> str:
    parts = []
    for b in ("inner", "middle", "outer"):
        parts.append(f"count(*) FILTER (band = '{b}') AS density_{b}")
        parts.append(f"round(avg(altitude) FILTER (band = '{b}'), 9) AS mean_alt_{b}")
        parts.append(f"round(avg(ground_speed) FILTER (band = '{b}'), 9) AS mean_speed_{b}")
        parts.append(f"round(stddev_samp(altitude) FILTER (band = '{b}'), 6) AS alt_std_{b}")
    return (
        "SELECT snapshot_ts, " + ", ".join(parts)
        + ", count(*) FILTER (band <> 'outside') AS total_density FROM snb GROUP BY 1"
    )


def rounded_density(df, *keep):
    columns = []
    for b in ("inner", "middle", "outer"):
        columns += [f"density_{b}", *r9(f"mean_alt_{b}", f"mean_speed_{b}")]
        columns.append(F.round(f"alt_std_{b}", 6).alias(f"alt_std_{b}"))
    return df.select(*keep, *columns, "total_density")


@query("snapshot_density", _density_sql(), "snb")
def snapshot_density(spark, root):
    return rounded_density(spatial.snapshot_density(bindings.snapshots(spark, root)), "snapshot_ts")


@query(
    "density_grid",
    """SELECT CAST(floor(latitude / 0.1::DOUBLE) AS BIGINT) AS lat_cell, CAST(floor(longitude / 0.1::DOUBLE) AS BIGINT) AS lon_cell,
       count(*) AS n, round(avg(altitude), 9) AS mean_altitude FROM sn GROUP BY 1, 2""",
    "sn",
)
def density_grid(spark, root):
    return spatial.density_grid(bindings.snapshots(spark, root)).withColumn(
        "mean_altitude", F.round("mean_altitude", 9)
    )


# Places of the nations as centres: arithmetic on the key, inside and around the box of the reports.
CENTRES = "SELECT n_nationkey AS centre, 39.5 + n_nationkey * 7 % 25 / 25.0 * 2.0 AS centre_lat, -5.0 + n_nationkey * 11 % 25 / 25.0 * 3.0 AS centre_lon FROM nation"


def nation_centres(spark, root):
    key = F.col("n_nationkey")
    return bindings.table(spark, root, "nation").select(
        key.alias("centre"), (39.5 + key * 7 % 25 / 25.0 * 2.0).alias("centre_lat"), (-5.0 + key * 11 % 25 / 25.0 * 3.0).alias("centre_lon")
    )


@query(
    "centre_density",
    f"""WITH c AS ({CENTRES}), d AS (
         SELECT centre, snapshot_ts, altitude, ground_speed, 1.852 * 2.0 * 3440.065 * asin(sqrt(least(1.0, pow(sin((radians(latitude) - radians(centre_lat)) / 2), 2)
           + cos(radians(centre_lat)) * cos(radians(latitude)) * pow(sin((radians(longitude) - radians(centre_lon)) / 2), 2)))) AS km FROM sn, c
       ), b AS (SELECT *, CASE {" ".join(f"WHEN km >= {lo} AND km < {hi} THEN '{name}'" for name, lo, hi in spatial.DEFAULTS.bands_km)} ELSE 'outside' END AS band FROM d)
       {_density_sql().replace("SELECT snapshot_ts", "SELECT centre, snapshot_ts").replace("FROM snb GROUP BY 1", "FROM b WHERE band <> 'outside' GROUP BY 1, 2")}""",
    "sn",
)
def centre_density(spark, root):
    """Densities around all centres at once."""
    found = spatial.centre_density(bindings.snapshots(spark, root), nation_centres(spark, root))
    return rounded_density(found, "centre", "snapshot_ts")


@query(
    "hex_grid",
    """WITH a AS (SELECT altitude, (longitude * (sqrt(3.0) / 3) - latitude / 3) / 0.1::DOUBLE AS q, latitude * (2.0::DOUBLE / 3) / 0.1::DOUBLE AS r FROM sn),
       c AS (SELECT *, floor(q + 0.5) AS fq, floor(r + 0.5) AS fr, floor(-q - r + 0.5) AS fs FROM a),
       o AS (SELECT *, abs(fq - q) AS dq, abs(fr - r) AS dr, abs(fs + q + r) AS ds FROM c)
       SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -fr - fs ELSE fq END AS BIGINT) AS hex_q,
              CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -fq - fs ELSE fr END AS BIGINT) AS hex_r,
              count(*) AS n, round(avg(altitude), 9) AS mean_altitude FROM o GROUP BY 1, 2""",
    "sn",
)
def hex_grid(spark, root):
    return spatial.hex_grid(bindings.snapshots(spark, root)).withColumn("mean_altitude", F.round("mean_altitude", 9))
