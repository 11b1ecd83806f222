"""Scene metadata and file listings as tables: one Spark job over all scenes, with what is incomplete set apart.

`files` has `path` and, where a file's content is read, `content` (text or bytes), as Spark's binaryFile source gives them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.functions import catalog as C
from landweave.functions import geometry as G
from landweave.functions.xml import xml_values

# Names of the surface reflectance bands by instrument, of the granule's band files by suffix,
# of the terrain and climate layers, and the pattern of a scene's metadata file.
_TM = {"blue": "sr_band1", "green": "sr_band2", "red": "sr_band3", "nir": "sr_band4", "swir1": "sr_band5", "swir2": "sr_band7"}
_OLI = {"blue": "sr_band2", "green": "sr_band3", "red": "sr_band4", "nir": "sr_band5", "swir1": "sr_band6", "swir2": "sr_band7"}
LANDSAT_BANDS = {"TM": _TM, "ETM": _TM, "OLI_TIRS": _OLI}
GRANULE_BANDS = {"blue": "B02", "green": "B03", "red": "B04", "re1": "B05", "re2": "B06", "re3": "B07", "nir": "B8A", "swir1": "B11", "swir2": "B12", "qual": "SCL"}
TERRAIN_FILES = {"elevation": "srtm_mosaic", "slope": "slope_mosaic", "aspect": "aspect_mosaic"}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_GLOBAL, _PLACE, _GRID = "global_metadata", "global_metadata/projection_information", "Geometric_Info/Tile_Geocoding"
_LANDSAT_PATHS = {
    "platform": f"{_GLOBAL}/satellite", "instrument": f"{_GLOBAL}/instrument", "date": f"{_GLOBAL}/acquisition_date", "time": f"{_GLOBAL}/scene_center_time",
    **{f"{at.lower()}{axis}": f"{_PLACE}/corner_point[@location='{at}']/@{axis}" for at in ("UL", "LR") for axis in "xy"}, "zone": f"{_PLACE}/utm_proj_params/zone_code",
    **{b: f"bands/band[@name='{b}']/file_name" for b in sorted({*_TM.values(), *_OLI.values(), "pixel_qa"})},
}
_GRANULE_PATHS = {
    "sensed": "General_Info/SENSING_TIME", "code": f"{_GRID}/HORIZONTAL_CS_CODE",
    **{n.lower(): f"{_GRID}/Size[@resolution='20']/{n}" for n in ("NROWS", "NCOLS")}, **{n.lower(): f"{_GRID}/Geoposition[@resolution='20']/{n}" for n in ("ULX", "ULY")},
}
LANDSAT_XML = r"[A-Z0-9]{4}_[A-Z0-9]{4}_\d{6}_\d{8}_\d{8}_01_(T1|T2|RT)\.xml$"

#: File patterns (on the base name) of products that their file names describe.
RADAR = {"vh": r"_VH_.*filtered\.tif$", "vv": r"_VV_.*filtered\.tif$"}
TERRAIN = {k: rf"^{v}\.tif$" for k, v in TERRAIN_FILES.items()}
CLIMATE = {f"{v}_{m}": rf"^{v}_{i}\.tif$" for v in ("tmax", "tmean", "tmin") for i, m in enumerate(MONTHS, 1)}


def list_files(spark: SparkSession, path: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """path (and content) of the files below a folder; without content, none is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("content").cast("string").alias("content")) if content else files.select("path")


def folder_of(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def file_manifest(files: DataFrame, parts: dict[str, str], folder: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(complete, rejects): for each folder the path of every part (name -> pattern of the base name; the first path of several).

    Rejects have `folder` and `missing`, the names of the parts without a file.
    """
    base = C.file_basename(F.col("path"))
    found = files.withColumn("folder", folder_of(F.col("path")) if folder is None else folder)
    out = found.groupBy("folder").agg(*[F.min(F.when(base.rlike(p), F.col("path"))).alias(n) for n, p in parts.items()])
    missing = F.filter(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in parts]), lambda c: c.isNotNull())
    out = out.withColumn("missing", missing)
    return out.where(F.size("missing") == 0).drop("missing"), out.where(F.size("missing") > 0).select("folder", "missing")


def radar_scenes(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of polarisations with `acquired`, from the digits (with or without a T) before the name's first underscore."""
    pairs, rejects = file_manifest(files, RADAR)
    stamp = F.replace(F.regexp_extract(C.file_basename(F.col("vh")), "^([^_]*)_", 1), F.lit("T"), F.lit(""))
    return pairs.withColumn("acquired", F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))), rejects


def numbered_tiles(files: DataFrame) -> DataFrame:
    """Files named ..._N.tif with their number; others are no tiles."""
    number = F.regexp_extract(F.col("path"), r"_(\d+)\.tif$", 1)
    return files.where(number != "").select("path", number.cast("long").alias("number"))


def _corners(df: DataFrame) -> DataFrame:
    """Longitude and latitude of the four corners of (ulx, uly, lrx, lry) in the UTM zone of `zone` (negative: south)."""
    at = lambda x, y: G.transverse_mercator_inverse(F.col(x), F.col(y), F.abs("zone"), F.col("zone") < 0)
    corners = {"ul": at("ulx", "uly"), "ur": at("lrx", "uly"), "lr": at("lrx", "lry"), "ll": at("ulx", "lry")}
    df = df.withColumns({f"__{k}": c for k, c in corners.items()})
    df = df.withColumns({f"{k}_{n}": F.col(f"__{k}.{a}") for k in corners for n, a in (("lon", "x"), ("lat", "y"))})
    return df.drop(*[f"__{k}" for k in corners])


def _split(df: DataFrame, needed: list[str]) -> tuple[DataFrame, DataFrame]:
    whole = F.lit(True)
    for c in needed:
        whole = whole & F.col(c).isNotNull()
    whole = whole & (F.col("n_metadata") == 1)
    reason = F.when(F.col("n_metadata") != 1, F.lit("not exactly one metadata file")).otherwise(F.lit("incomplete metadata"))
    return df.where(whole).drop("n_metadata"), df.where(~whole).select("folder", reason.alias("reason"))


def _parsed(files: DataFrame, xml: Column, paths: dict[str, str], *aggs: Column) -> DataFrame:
    """folder, n_metadata and `m`, the values of its (first) metadata file: each is parsed once, before the shuffle, which carries no text.

    Folders are dealt first, so that values are sorted once and in small partitions; strings have no other aggregate.
    """
    read = files.select("folder", "path", xml_values(F.when(xml, F.col("content")), paths).alias("m"), xml.alias("__xml"))
    return read.repartition("folder").groupBy("folder").agg(F.count_if("__xml").alias("n_metadata"), F.min_by("m", F.when(F.col("__xml"), F.col("path"))).alias("m"), *aggs)


def scene_metadata_landsat(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scenes, rejects) of folders of scene files: id, folder, acquired, instrument, platform, zone, corners, a path for each band and `qual`.

    A folder has exactly one metadata file of the scene pattern; otherwise, or if a field is missing, it is a reject.
    """
    xml = F.col("path").rlike(LANDSAT_XML)
    m = F.col("m")
    band = lambda name: F.concat(F.col("folder"), F.lit("/"), m[name])
    rows = _parsed(files.withColumn("folder", folder_of(F.col("path"))), xml, _LANDSAT_PATHS).select(
        "folder", "n_metadata", "m", C.dataset_uuid(F.col("folder")).alias("id"), F.try_to_timestamp(F.concat_ws(" ", m["date"], F.substring(m["time"], 1, 8))).alias("acquired"),
        m["instrument"].alias("instrument"), m["platform"].alias("platform"), m["zone"].try_cast("int").alias("zone"), *[m[c].try_cast("double").alias(c) for c in ("ulx", "uly", "lrx", "lry")],
    )
    kinds = lambda b: F.coalesce(*[F.when(F.col("instrument") == i, band(names[b])) for i, names in LANDSAT_BANDS.items()])
    rows = rows.withColumns({b: kinds(b) for b in _TM} | {"qual": band("pixel_qa")}).drop("m")
    return _split(_corners(rows), ["acquired", "zone", "ulx", "uly", "lrx", "lry", *_TM, "qual"])


def scene_metadata_s2(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scenes, rejects) of granules: as for Landsat scenes, with the band files found by their suffix below the scene's folder (`*.SAFE`).

    The lower right corner follows from the size at 20 m.
    """
    path, name = F.col("path"), C.file_basename(F.col("path"))
    xml = path.rlike(r"GRANULE.*MTD_TL\.xml$")
    files = files.withColumn("folder", F.regexp_extract("path", "^(.*?)/GRANULE/", 1)).where("folder <> ''")
    image = path.rlike(r"GRANULE/.*/IMG_DATA/R20m/")
    aggs = [F.min(F.when(image & name.rlike(rf"{s}_20m\.jp2$"), path)).alias(b) for b, s in GRANULE_BANDS.items()]
    by, m = _parsed(files, xml, _GRANULE_PATHS, *aggs), F.col("m")
    zone = F.regexp_extract(m["code"], r"32[67](\d\d)$", 1).try_cast("int")
    size = lambda n: m[n].try_cast("int") * 20
    rows = by.withColumns({
        "id": C.dataset_uuid(F.col("folder")), "acquired": F.try_to_timestamp(F.regexp_extract(m["sensed"], r"^([^.Z]*)", 1)),
        "instrument": F.lit("MSI"), "platform": F.lit("sentinel2"), "zone": F.when(m["code"].rlike(r"327\d\d$"), -zone).otherwise(zone), "ulx": m["ulx"].try_cast("double"), "uly": m["uly"].try_cast("double"),
    })
    rows = rows.withColumns({"lrx": F.col("ulx") + size("ncols"), "lry": F.col("uly") - size("nrows")}).drop("m")
    return _split(_corners(rows), ["acquired", "zone", "lrx", "lry", *GRANULE_BANDS])


def prepare_metadata(files: DataFrame, kind: str, path: str) -> DataFrame:
    """Write the scenes and the rejects of all folders below `path`; returns the rejects."""
    kinds = {"landsat": scene_metadata_landsat, "s2": scene_metadata_s2, "radar": radar_scenes, "terrain": lambda f: file_manifest(f, TERRAIN), "climate": lambda f: file_manifest(f, CLIMATE)}
    if kind not in kinds:
        raise ValueError(f"no product {kind!r}; there are {sorted(kinds)}")
    scenes, rejects = kinds[kind](files)
    scenes.write.mode("overwrite").parquet(f"{path}/scenes")
    rejects.write.mode("overwrite").parquet(f"{path}/rejects")
    return files.sparkSession.read.parquet(f"{path}/rejects")
