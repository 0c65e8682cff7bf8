"""Naming, path and text-formatting Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output product family and its file-name template
# "{product}_{yref}{xref}_{year:04}{month:02}"; refs are signed 3-digit
# tile indices with E/W (x) and N/S (y) instead of the sign.
COMPOSITE_PRODUCT = "landsat8_geomedian_monthly"
INPUT_PRODUCT = "landsat8_c2l2_sr"
# Fixed value: region code pattern inside a DEM dataset label, e.g.
# Copernicus_DSM_COG_10_S10_00_E141_00_DEM -> S10E141.
REGION_CODE_PATTERN = r"([NS]\w{2})_\d{2}_([EW]\w{3})"
# Fixed value: version folder inserted by the copy-and-edit job.
DEFAULT_VERSION = "2020_2"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def signed_ref(v, pos: str, neg: str) -> Column:
    """'+024' → 'E024', '-065' → 'S065'; zero is positive; ≥3 digits."""
    v = _c(v)
    return F.format_string("%s%03d", F.when(v < 0, F.lit(neg)).otherwise(F.lit(pos)),
                           F.abs(v).cast("int"))


def tile_product_name(product, tile_x, tile_y, month) -> Column:
    """``{product}_{yref}{xref}_{yyyy}{mm}`` for a tile and month start."""
    p = F.lit(product) if isinstance(product, str) else product
    m = _c(month)
    return F.format_string("%s_%s%s_%04d%02d", p,
                           signed_ref(tile_y, "N", "S"), signed_ref(tile_x, "E", "W"),
                           F.year(m), F.month(m))


def wkt_polygon(xs: list, ys: list) -> Column:
    """``POLYGON((x y, x y, ...))`` from corner Columns (ring closed by caller)."""
    parts = [F.concat_ws(" ", _c(x).cast("string"), _c(y).cast("string")) for x, y in zip(xs, ys)]
    return F.concat(F.lit("POLYGON(("), F.concat_ws(", ", *parts), F.lit("))"))


def epsg_code(crs) -> Column:
    """'epsg:32751' → 32751 (text after the 5-character prefix)."""
    return F.substring(_c(crs), 6, 1 << 20).try_cast("int")


def region_code(label) -> Column:
    """'S10' + 'E141' from a DEM label; empty string when absent."""
    lab = _c(label)
    return F.concat(F.regexp_extract(lab, REGION_CODE_PATTERN, 1),
                    F.regexp_extract(lab, REGION_CODE_PATTERN, 2))


def versioned_path(path, version: str = DEFAULT_VERSION) -> Column:
    """insert ``v{version}`` as the folder before the basename."""
    return F.regexp_replace(_c(path), r"/([^/]+)$", f"/v{version}/$1")


def basename(path) -> Column:
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def parent(path) -> Column:
    return F.regexp_extract(_c(path), r"^(.*)/[^/]*$", 1)


def normalise_key(path) -> Column:
    """'s3://b/k', 'file:/b/k', '/b/k' and 'b/k' all become 'b/k'
    (scheme and leading slashes dropped)."""
    return F.regexp_replace(_c(path), r"^([A-Za-z][A-Za-z0-9+.-]*:)?/*", "")


def elapsed_text(seconds) -> Column:
    """under 120 s in seconds, under an hour in minutes, else hours (2 dp)."""
    s = _c(seconds).cast("double")
    return (F.when(s < 120, F.format_string("%.2f seconds", s))
            .when(s < 3600, F.format_string("%.2f minutes", s / 60.0))
            .otherwise(F.format_string("%.2f hours", s / 3600.0)))


def month_end_label(month) -> Column:
    """F16 as text: last day of the month of ``month`` ('yyyy-MM-dd')."""
    m = _c(month)
    return F.date_format(F.date_sub(F.add_months(m, 1), 1), "yyyy-MM-dd")
