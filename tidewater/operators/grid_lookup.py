"""Grid-field lookups.

A gridded field is a long table ``(t, y, x, value...)``; an absent row is a
masked cell.  A lookup computes the cell key of every report with the index
expressions of :mod:`tidewater.functions.grid` and left-joins the field.

Size policy: a field's row count is bounded by its declared geometry
(``n * 180/res * 360/res``).  The field is broadcast when that bound (times
the row width) is within the declared limit; beyond it Spark shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import grid as G
from tidewater.functions.calendar import valid_day_2004

# A 1-degree pentad field is ~4.7M cells; broadcasting it (bounded by geometry)
# avoids shuffling the report table, which at scale is the large side by many
# orders of magnitude.  Building a broadcast needs driver memory, so the limit
# is a session setting: 64 MB by default (safe for a 1 GB driver), raise
# ``spark.tidewater.gridBroadcastBytes`` (e.g. to 512 MB) on clusters whose
# driver can hold the grid.
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
BROADCAST_CONF = "spark.tidewater.gridBroadcastBytes"


def grid_rows_bound(n: int, res: float) -> int:
    return int(n * round(180 / res) * round(360 / res))


def sized_join_side(field: DataFrame, n: int, res: float, n_values: int,
                    broadcast_limit_bytes: int | None = None) -> DataFrame:
    """The field with a broadcast hint if its geometric size bound is within
    the declared limit, else with a merge hint: the declared geometry and
    limit alone decide, at every input size alike."""
    if broadcast_limit_bytes is None:
        conf = field.sparkSession.conf.get(BROADCAST_CONF, None)
        broadcast_limit_bytes = int(conf) if conf else DEFAULT_BROADCAST_LIMIT
    approx_bytes = grid_rows_bound(n, res) * (12 + 8 * max(n_values, 1))
    # not broadcasting is stated explicitly: compressed grid files look tiny
    # to the planner's automatic broadcast, but expand far beyond it in memory
    if approx_bytes > broadcast_limit_bytes:
        return field.hint("merge")
    return F.broadcast(field)


def cell_keys(df: DataFrame, n: int, res: float, style: str, lat="lat", lon="lon",
              mo="mo", dy="dy", prefix="_k") -> DataFrame:
    """Add the (t, y, x) keys of a field with ``n`` time steps at ``res``.

    style ``mds``: MDS borderline rules on a longitude in -180..180;
    style ``regular``: regular rows/columns, borderline pushed south/east.
    Invalid month/day (in the leap year 2004) gives a NULL key, i.e. no value.
    """
    la, lo = F.col(lat), F.col(lon)
    if style == "mds":
        y, x = G.mds_yindex(la, res), G.mds_xindex(G.lon180(lo), res)
    elif style == "regular":
        y, x = G.reg_yindex(la, res), G.reg_xindex(lo, res)
    else:
        raise ValueError(style)
    ok = valid_day_2004(mo, dy) & la.isNotNull() & lo.isNotNull()
    t = F.when(ok, G.time_index(n, F.col(mo), F.col(dy))) if n != 1 else F.when(ok, F.lit(0))
    return df.withColumns({f"{prefix}t": t, f"{prefix}y": y, f"{prefix}x": x})


def grid_lookup(df: DataFrame, field: DataFrame, values: dict[str, str], n: int = 73,
                res: float = 1.0, style: str = "regular", lat="lat", lon="lon",
                mo="mo", dy="dy", broadcast_limit_bytes: int | None = None) -> DataFrame:
    """Left-join field columns ``values`` ({field_col: output_col}) onto df."""
    k = "_k"
    keyed = cell_keys(df, n, res, style, lat, lon, mo, dy, prefix=k)
    side = field.select(
        F.col("t").alias(f"{k}t"), F.col("y").alias(f"{k}y"), F.col("x").alias(f"{k}x"),
        *[F.col(src).alias(dst) for src, dst in values.items()],
    )
    side = sized_join_side(side, n, res, len(values), broadcast_limit_bytes)
    out = keyed.join(side, [f"{k}t", f"{k}y", f"{k}x"], "left")
    return out.drop(f"{k}t", f"{k}y", f"{k}x")


def as_grid_table(df: DataFrame, n: int, res: float, value: str = "value", flip_lat: bool = False,
                  roll_lon: bool = False, transpose: bool = False, level: str | None = None) -> DataFrame:
    """Re-index a tabular field to the (t, y, x) convention (S17): y = 0 at
    the north, x = 0 at 180W.  ``transpose`` for fields whose y and x are
    swapped, ``flip_lat`` for fields stored south-first, ``roll_lon`` for
    fields whose first column is at 0E; of a field with a ``level`` column
    the first level (0) is taken.  Missing values and steps from ``n`` on are left out."""
    ny, nx = int(round(180 / res)), int(round(360 / res))
    row, col = (F.col("x"), F.col("y")) if transpose else (F.col("y"), F.col("x"))
    y = (F.lit(ny - 1) - row) if flip_lat else row
    x = F.pmod(col + nx // 2, F.lit(nx)) if roll_lon else col
    if level is not None:
        df = df.where(F.col(level) == 0)
    return df.select(F.col("t").cast("int").alias("t"), y.cast("int").alias("y"),
                     x.cast("int").alias("x"), F.col(value).alias("value")).where(
        F.col("value").isNotNull() & (F.col("t") < n))


def _corners(lat: Column, lon: Column, max90: bool):
    """Centres (x1, x2, y1, y2) of the four 1-degree cells around a point."""
    x2 = G.xindex_to_lon(G.reg_xindex(lon + 0.5))
    x2 = F.when(x2 < lon, x2 + 360.0).otherwise(x2)
    x1 = G.xindex_to_lon(G.reg_xindex(lon - 0.5))
    x1 = F.when(x1 > lon, x1 - 360.0).otherwise(x1)
    y2 = F.when(lat + 0.5 <= 90, G.yindex_to_lat(G.reg_yindex(lat + 0.5))).otherwise(F.lit(89.5 if max90 else 90.5))
    y1 = F.when(lat - 0.5 >= -90, G.yindex_to_lat(G.reg_yindex(lat - 0.5))).otherwise(F.lit(-89.5 if max90 else -90.5))
    return x1, x2, y1, y2


def corner_stencil(field: DataFrame, value: str) -> DataFrame:
    """J13, the field's side: (t, r, c, nw, ne, sw, se) for every node of the
    1-degree grid, the point where four cells meet (r = 0 .. 180 from the
    north, c = 0 .. 359 the column east of it).  Beyond a pole a node has the
    polar row on both sides.  Laid out once for a field, so a report needs one
    key and one join; nodes without any value are absent."""
    cells = field.where(F.col(value).isNotNull()).select("t", "y", "x", F.col(value).cast("double").alias("v"))
    last = 179
    polar = F.when(F.col("y") == 0, F.lit(0)).when(F.col("y") == last, F.lit(last + 1))
    east = F.pmod(F.col("x") + 1, F.lit(360))  # the node at a cell's eastern edge
    parts = [F.struct(row.alias("r"), col.alias("c"), F.lit(f"{ns}{we}").alias("k"))
             for row, sides in ((F.col("y"), "s"), (F.col("y") + 1, "n"), (polar, "ns")) for ns in sides
             for col, we in ((F.col("x"), "e"), (east, "w"))]
    # a cell lies south of the node row above it and north of the one below; polar rows lie on both
    # sides of the pole's own row, where one of the two is laid out already
    at_pole = F.array_distinct(F.filter(F.array(*parts), lambda e: e["r"].isNotNull()))
    laid = cells.select("t", "v", F.explode(at_pole).alias("e"))
    return laid.groupBy("t", F.col("e.r").alias("r"), F.col("e.c").alias("c")).agg(
        *[F.max(F.when(F.col("e.k") == k, F.col("v"))).alias(k) for k in ("nw", "ne", "sw", "se")])


def bilinear_lookup(df: DataFrame, field: DataFrame, value: str, out: str, n: int = 73, lat="lat", lon="lon",
                    mo="mo", dy="dy", stencil: DataFrame | None = None,
                    broadcast_limit_bytes: int | None = None) -> DataFrame:
    """Bilinear interpolation of a 1-degree field at each report.

    The four cell centres around the point are one row of the field's
    ``corner_stencil`` (pass a stored one, or it is laid out here), fetched by
    one join on the node.  Four probes 0.001 degrees around the point (north
    probes only below 90, south only above -90) lie in these cells; at least one must
    have a value, else NULL.  A missing corner is filled from the mean of
    its two neighbours, else the opposite corner; the value is interpolated
    with the polar rows extended to +-90.5."""
    la, lo = F.col(lat), G.lon180(F.col(lon))
    ok = valid_day_2004(mo, dy) & la.isNotNull() & lo.isNotNull()
    t = F.when(ok, G.time_index(n, F.col(mo), F.col(dy))) if n != 1 else F.when(ok, F.lit(0))
    x1, x2, y1, y2 = _corners(la, lo, True)
    d = df.withColumns({"_t": t, "_yn": G.reg_yindex(y2), "_ys": G.reg_yindex(y1), "_xw": G.reg_xindex(x1), "_xe": G.reg_xindex(x2)})
    node = F.when(F.col("_yn") != F.col("_ys"), F.col("_ys")).when(F.col("_yn") == 0, F.lit(0)).otherwise(F.lit(180))
    d = d.withColumns({"_r": node, "_c": F.col("_xe")})
    side = stencil if stencil is not None else corner_stencil(field, value)
    side = side.select(F.col("t").alias("_t"), F.col("r").alias("_r"), F.col("c").alias("_c"),
                       *[F.col(k).alias(f"_{k}") for k in ("nw", "ne", "sw", "se")])
    d = d.join(sized_join_side(side, n, 1.0, 4, broadcast_limit_bytes), ["_t", "_r", "_c"], "left")
    q11, q22, q12, q21 = (F.col(c) for c in ("_sw", "_ne", "_nw", "_se"))

    def probe(py, px, use):
        row, col = G.reg_yindex(py), G.reg_xindex(px)
        north, west = row == F.col("_yn"), col == F.col("_xw")
        cell = F.when(north & west, q12).when(north, q22).when(west, q11).otherwise(q21)
        return use & cell.isNotNull()

    seen = (probe(la + 0.001, lo + 0.001, la + 0.001 < 90) | probe(la + 0.001, lo - 0.001, la + 0.001 < 90)
            | probe(la - 0.001, lo + 0.001, la - 0.001 > -90) | probe(la - 0.001, lo - 0.001, la - 0.001 > -90))

    def mean2(a, b):
        return F.when(a.isNotNull() & b.isNotNull(), (a + b) / 2.0).otherwise(F.coalesce(a, b))

    d = d.withColumns({
        "_any": seen, "_f11": F.coalesce(q11, mean2(q12, q21), q22), "_f22": F.coalesce(q22, mean2(q12, q21), q11),
        "_f12": F.coalesce(q12, mean2(q11, q22), q21), "_f21": F.coalesce(q21, mean2(q11, q22), q12)})
    bx1, bx2, by1, by2 = _corners(la, lo, False)
    val = (F.col("_f11") * (bx2 - lo) * (by2 - la) + F.col("_f21") * (lo - bx1) * (by2 - la)
           + F.col("_f12") * (bx2 - lo) * (la - by1) + F.col("_f22") * (lo - bx1) * (la - by1)) \
        / ((bx2 - bx1) * (by2 - by1))
    return d.select(*[F.col(f"`{c}`") for c in df.columns], F.when(F.col("_any"), val).alias(out))


# --- J11: fields too large to broadcast -----------------------------------------------
#: Latitude bands of a stored time slice.
BANDS = 12


def write_slices(field: DataFrame, path: str, res: float) -> None:
    """Store a field (t, y, x, values) by time step and latitude band, so that
    a lookup reads only the parts of the world and year its reports lie in."""
    band = F.floor(F.col("y") * BANDS / round(180 / res)).cast("int")
    (field.withColumn("band", band).repartition("t", "band").sortWithinPartitions("t", "band", "y", "x")
     .write.mode("overwrite").partitionBy("t", "band").parquet(path))


def slice_lookup(df: DataFrame, path: str, values: dict[str, str], n: int = 365, res: float = 0.25, style: str = "regular",
                 lat="lat", lon="lon", mo="mo", dy="dy") -> DataFrame:
    """Field columns ``values`` ({field_col: output_col}) of a field
    stored by ``write_slices``, for the rows of ``df``, which should be narrow
    (a key and what is checked): they are shuffled once, by cell.

    A 0.25-degree field of 365 steps has 378 million cells, too many to
    broadcast or to sort for every run.  The slices to read are the time steps
    and bands in which there are reports (at most n * BANDS pairs, found by a
    small aggregation); within them a semi-join with the occupied cells leaves
    no more rows than there are cells with reports, and those are joined."""
    spark = df.sparkSession
    keyed = cell_keys(df, n, res, style, lat, lon, mo, dy)
    band = F.floor(F.col("_ky") * BANDS / round(180 / res)).cast("int")
    keyed = keyed.withColumn("_kb", F.when(F.col("_kt").isNotNull(), band))
    here = F.col("_kt").isNotNull()
    located = keyed.where(here)
    wanted = [(r[0], r[1]) for r in located.select("_kt", "_kb").distinct().collect()]  # at most n * BANDS
    field = spark.read.parquet(path)
    steps: dict[int, list[int]] = {}
    for step, b in wanted:
        steps.setdefault(b, []).append(step)
    parts = F.lit(False)
    for b, s in sorted(steps.items()):
        parts = parts | ((F.col("band") == b) & F.col("t").isin(sorted(s)))
    cells = located.select("_kt", "_ky", "_kx").distinct()
    # values under their own names: an output may be called like another field column
    side = field.where(parts).select(F.col("t").alias("_kt"), F.col("y").alias("_ky"), F.col("x").alias("_kx"),
                                     *[F.col(src).alias(f"_v{i}") for i, src in enumerate(values)])
    occupied = side.hint("merge").join(cells, ["_kt", "_ky", "_kx"], "left_semi")
    found = located.join(occupied, ["_kt", "_ky", "_kx"], "left")
    out = [F.col(f"_v{i}").alias(dst) for i, dst in enumerate(values.values())]
    types = [side.schema[f"_v{i}"].dataType for i in range(len(values))]
    none = keyed.where(~here).select(*[F.col(f"`{c}`") for c in df.columns],
                                     *[F.lit(None).cast(t).alias(dst) for t, dst in zip(types, values.values(), strict=True)])
    return found.select(*[F.col(f"`{c}`") for c in df.columns], *out).unionByName(none)
