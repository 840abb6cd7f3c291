"""Distance, bands and densities of position reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DEFAULTS, Settings

EARTH_RADIUS_NM = 3440.065
KM_PER_NM = 1.852
KM_PER_DEGREE = EARTH_RADIUS_NM * KM_PER_NM * 3.141592653589793 / 180


def haversine_nm(lat1: Column | float, lon1: Column | float, lat2: Column, lon2: Column) -> Column:
    def col(v):
        return v if isinstance(v, Column) else F.lit(float(v))

    a1, o1, a2, o2 = (F.radians(col(v)) for v in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return 2.0 * EARTH_RADIUS_NM * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def band_label(distance_nm: Column, bands_km: Sequence[tuple[str, float, float]]) -> Column:
    """First band with inner <= distance < outer, else ``outside``; NULL distance stays NULL."""
    km = distance_nm * KM_PER_NM
    out = F.when(distance_nm.isNull(), F.lit(None).cast("string"))
    for label, inner, outer in bands_km:
        out = out.when((km >= inner) & (km < outer), label)
    return out.otherwise("outside")


def in_box(lat: Column, lon: Column, s: Settings = DEFAULTS) -> Column:
    """Four range predicates that reach the scan."""
    return (
        (lat >= s.box_south) & (lat <= s.box_north) & (lon >= s.box_west) & (lon <= s.box_east)
    )


def with_band(df: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    nm = haversine_nm(s.centre_lat, s.centre_lon, F.col("latitude"), F.col("longitude"))
    return df.withColumn("distance_nm", nm).withColumn(
        "band", band_label(F.col("distance_nm"), s.bands_km)
    )


def density_columns(s: Settings = DEFAULTS) -> list[Column]:
    """Conditional aggregates per band; no pivot, so no extra job for its values."""
    out = []
    for label, _, _ in s.bands_km:
        here = F.col("band") == label
        out += [
            F.count(F.when(here, 1)).alias(f"density_{label}"),
            F.avg(F.when(here, F.col("altitude"))).alias(f"mean_alt_{label}"),
            F.avg(F.when(here, F.col("ground_speed"))).alias(f"mean_speed_{label}"),
            F.stddev_samp(F.when(here, F.col("altitude"))).alias(f"alt_std_{label}"),
        ]
    inside = F.count(F.when(F.col("band") != "outside", 1)).alias("total_density")
    return [*out, inside]


def snapshot_density(snapshots: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Aircraft per snapshot time and band with altitude and speed statistics."""
    return with_band(snapshots, s).groupBy("snapshot_ts").agg(*density_columns(s))


def density_grid(snapshots: DataFrame, cell: float = 0.1) -> DataFrame:
    """Counts on a fixed grid of ``cell`` degrees."""
    return snapshots.groupBy(
        F.floor(F.col("latitude") / cell).alias("lat_cell"),
        F.floor(F.col("longitude") / cell).alias("lon_cell"),
    ).agg(F.count(F.lit(1)).alias("n"), F.avg("altitude").alias("mean_altitude"))


def near_centres(reports: DataFrame, centres: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Every report with every centre in whose bands it lies: ``reports``, ``centre``, ``distance_nm``, ``band``.

    ``centres``: ``centre, centre_lat, centre_lon``, any number of them. Space is cut into cells as high as the
    outermost band reaches. A centre is entered in all cells that its circle can touch (its longitudes widen towards the poles
    and wrap around), a report looks only its own cell up, and the distance confirms. Reports or centres without a position or
    off the globe have no cell.
    """
    reach = max(outer for _, _, outer in s.bands_km) / KM_PER_DEGREE
    n = int(360 // reach) or 1
    width = 360 / n

    def lat_cell(c: Column) -> Column:
        return F.floor((c + 90) / reach).cast("long")

    def lon_cell(c: Column) -> Column:
        return F.pmod(F.floor((c + 180) / width), F.lit(n)).cast("long")

    def on_globe(lat: str, lon: str) -> Column:
        return F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)

    lat, lon = F.col("centre_lat"), F.col("centre_lon")
    farthest = F.greatest(F.abs(lat - reach), F.abs(lat + reach))
    # the circle's widest meridian; a circle around a pole touches all of them
    spread = F.when(
        farthest < 89.9, F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(reach))) / F.cos(F.radians(lat))))) + 1e-9
    ).otherwise(F.lit(180.0))
    first, last = F.floor((lon - spread + 180) / width).cast("long"), F.floor((lon + spread + 180) / width).cast("long")
    entered = centres.where(on_globe("centre_lat", "centre_lon")).select(
        "centre", "centre_lat", "centre_lon",
        F.explode(F.sequence(lat_cell(lat - reach - 1e-9), lat_cell(lat + reach + 1e-9))).alias("_lat_cell"), first.alias("_first"), F.least(last, first + n - 1).alias("_last"),
    ).select("centre", "centre_lat", "centre_lon", "_lat_cell", F.explode(F.transform(F.sequence("_first", "_last"), lambda i: F.pmod(i, F.lit(n)))).alias("_lon_cell"))
    own = reports.where(on_globe("latitude", "longitude")).withColumns({"_lat_cell": lat_cell(F.col("latitude")), "_lon_cell": lon_cell(F.col("longitude"))})
    met = own.join(entered, ["_lat_cell", "_lon_cell"])
    nm = haversine_nm(lat, lon, F.col("latitude"), F.col("longitude"))
    found = met.withColumn("distance_nm", nm).withColumn("band", band_label(F.col("distance_nm"), s.bands_km))
    return found.where("band <> 'outside'").drop("_lat_cell", "_lon_cell", "centre_lat", "centre_lon")


def centre_density(reports: DataFrame, centres: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Aircraft per centre, snapshot time and band, for all centres at once."""
    return near_centres(reports, centres, s).groupBy("centre", "snapshot_ts").agg(*density_columns(s))


def hex_grid(snapshots: DataFrame, size: float = 0.1) -> DataFrame:
    """Counts on hexagons with corners ``size`` degrees from their middle, named by axial coordinates."""
    x, y = F.col("longitude"), F.col("latitude")
    q, r = (x * (3**0.5 / 3) - y / 3) / size, y * (2 / 3) / size
    near = lambda c: F.floor(c + 0.5)
    placed = snapshots.withColumns({"_q": q, "_r": r}).withColumn("_s", -F.col("_q") - F.col("_r"))
    off = {c: F.abs(near(F.col(c)) - F.col(c)) for c in ("_q", "_r", "_s")}
    # of the three rounded coordinates, which must add up to 0, the one that was rounded most gives way
    hex_q = F.when((off["_q"] > off["_r"]) & (off["_q"] > off["_s"]), -near(F.col("_r")) - near(F.col("_s"))).otherwise(near(F.col("_q")))
    hex_r = F.when(
        ~((off["_q"] > off["_r"]) & (off["_q"] > off["_s"])) & (off["_r"] > off["_s"]), -near(F.col("_q")) - near(F.col("_s"))
    ).otherwise(near(F.col("_r")))
    return placed.groupBy(hex_q.alias("hex_q"), hex_r.alias("hex_r")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("altitude").alias("mean_altitude")
    )
