"""Image colour questions over PNG data joined with JSON metadata.

Plan shape: the pixels of each image are generated as rows next to it
(``explode`` of pixel positions), named by a code-generated expression and
counted per image with one counter per colour. All pixels of an image sit in
the partition of its row, so the map-side partial aggregation emits exactly
one row per image: the shuffle carries one small row per image - never pixels
- and no key can be skewed. Only these per-image counts are joined with the
metadata (broadcast when Spark's size check allows, sort-merge otherwise), so
image bytes never cross a shuffle whatever the size of the metadata. Each
question is then a filter, a top-k (``TakeOrderedAndProject``: k rows per
partition are merged) or a one-row aggregate over one row per image.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.pixels import BASIC_COLORS, TRANSPARENT, pixel_color, pixel_hex
from touchline.plans.topn import top_k

IMAGE_KEYS = ["filename", "annotation", "group"]
COLOR_NAMES = sorted(set(BASIC_COLORS.values()))


def stem(origin: Column) -> Column:
    """Last segment of a path, percent signs decoded, without its extension."""
    last = F.try_url_decode(F.replace(F.element_at(F.split(origin, "/"), -1), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(last, r"(?<=.)\.[^.]*$", "")


def image_files(images: DataFrame) -> DataFrame:
    """(filename, nChannels, data) from ``image`` structs; filename = stem of the origin path."""
    return images.select(
        stem(F.col("image.origin")).alias("filename"),
        F.col("image.nChannels").alias("nChannels"),
        F.col("image.data").alias("data"),
    )


def _attach_metadata(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    meta = metadata.select(F.col("hexcode").alias("filename"), "annotation", "group")
    return rows.join(meta, "filename")


def images_with_metadata(images: DataFrame, metadata: DataFrame) -> DataFrame:
    """Image rows joined to their metadata by file name stem = ``hexcode``."""
    return _attach_metadata(image_files(images), metadata).select(
        "filename", "annotation", "group", "nChannels", "data"
    )


def pixel_colors(joined: DataFrame, keys: Sequence[str] = IMAGE_KEYS) -> DataFrame:
    """Colour name of every pixel, as an array per image (pixel order kept)."""
    return joined.select(
        *keys,
        F.transform(pixel_hex(F.col("data"), F.col("nChannels")), pixel_color).alias("colors"),
    )


def pixel_rows(files: DataFrame, keys: Sequence[str] = ("filename",)) -> DataFrame:
    """One row per pixel: image ``keys``, pixel position (0-based) and colour.

    Each pixel's bytes are cut from the binary (by address, so the cost is
    linear in the pixels; cutting text would walk from its start every time)
    and its hex is projected once before its colour is named. An image without
    pixel data keeps one row with a null position.
    """
    keys = list(keys)
    pixels = F.ceil(F.try_divide(F.length("data"), F.col("nChannels"))).cast("int")
    exploded = files.select(
        *keys,
        "data",
        "nChannels",
        F.explode_outer(F.when(pixels > 0, F.sequence(F.lit(0), pixels - 1))).alias("pixel"),
    )
    hexed = exploded.select(
        *keys,
        "pixel",
        F.hex(F.substring(F.col("data"), F.col("pixel") * F.col("nChannels") + 1, F.col("nChannels"))).alias("px"),
    )
    return hexed.select(*keys, "pixel", F.when(F.col("pixel").isNotNull(), pixel_color(F.col("px"))).alias("color"))


def _by_count(entries: list[tuple[str, Column]]) -> Column:
    """array<struct<color, pixels>> of the colours with pixels, most first
    (ties by name). Structs of (-pixels, color) sort in natural order."""
    keyed = F.array(*[F.struct((-count).alias("neg"), F.lit(name).alias("color")) for name, count in entries])
    present = F.filter(F.array_sort(keyed), lambda e: e["neg"] < 0)
    return F.transform(present, lambda e: F.struct(e["color"].alias("color"), (-e["neg"]).alias("pixels")))


def image_slices(files: DataFrame, keys: Sequence[str], slice_bytes: int) -> DataFrame:
    """Images cut into rows of at most ``slice_bytes`` (whole pixels), dealt over
    the shuffle partitions, so that many tasks share one large image."""
    per = F.greatest(F.lit(1), F.lit(slice_bytes).cast("int") - F.lit(slice_bytes).cast("int") % F.col("nChannels")).cast("int")
    parts = F.ceil(F.length("data") / per).cast("int")
    cut = files.select(*keys, "nChannels", "data", per.alias("per"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("slice"))
    cut = cut.select(*keys, "nChannels", "slice", F.substring(F.col("data"), F.col("slice") * F.col("per") + 1, F.col("per")).alias("data"))
    # a given number: small shuffles would be merged into few partitions again
    return cut.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "slice")


def color_counts(files: DataFrame, keys: Sequence[str] = ("filename",), split_bytes: int | None = None) -> DataFrame:
    """One row per image: total / coloured / transparent pixel counts,
    ``palette`` (non-transparent colours with counts, most frequent first)
    and ``counts`` (the same with transparent pixels as ``None``).

    With ``split_bytes``, images of more bytes are cut into slices of that size
    that different tasks count; only their bytes are shuffled. ``files`` is then
    read twice, for the small images and for the large ones, so ask for it where
    a single image would keep a task busy for long.
    """
    if split_bytes is None:
        counted = _counted(files, keys)
    else:
        large = F.coalesce(F.length("data") > split_bytes, F.lit(False)) & (F.col("nChannels") > 0)
        sliced = image_slices(files.where(large), keys, split_bytes)
        counted = _counted(files.where(~large), keys).unionByName(_counted(sliced, keys))
    palette = [(name, F.col(name)) for name in COLOR_NAMES]
    return counted.select(
        *keys,
        "total_pixels",
        (F.col("total_pixels") - F.col("transparent_pixels")).alias("colored_pixels"),
        "transparent_pixels",
        _by_count(palette).alias("palette"),
        _by_count(palette + [(TRANSPARENT, F.col("transparent_pixels"))]).alias("counts"),
    )


def _counted(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    color = F.col("color")
    return pixel_rows(files, keys).groupBy(*keys).agg(
        F.count("pixel").alias("total_pixels"),
        F.count_if(color == TRANSPARENT).alias("transparent_pixels"),
        *[F.count_if(color == name).alias(name) for name in COLOR_NAMES],
    )


def color_profile(images: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Per-image colour counts with ``annotation`` and ``group``.

    With ``metadata``, ``images`` holds ``image`` structs (the image source);
    the counts are computed first and only they are joined. Without it,
    ``images`` is an already joined frame (filename, annotation, group,
    nChannels, data).
    """
    if metadata is None:
        return color_counts(images, IMAGE_KEYS)
    return _attach_metadata(color_counts(image_files(images)), metadata).select(
        *IMAGE_KEYS, "total_pixels", "colored_pixels", "transparent_pixels", "palette", "counts"
    )


def color_histogram(profile: DataFrame) -> DataFrame:
    """(image, colour) -> pixel count, transparent pixels included as ``None``.

    An image without pixels keeps one row with a null colour and 0 pixels.
    """
    return profile.select(*IMAGE_KEYS, F.explode_outer("counts").alias("c")).select(
        *IMAGE_KEYS,
        F.col("c.color").alias("color"),
        F.coalesce(F.col("c.pixels"), F.lit(0)).alias("pixels"),
    )


def most_colored(profile: DataFrame, n: int = 4) -> DataFrame:
    """The ``n`` images with the most coloured (non-transparent) pixels."""
    return top_k(
        profile.select("annotation", "filename", "colored_pixels"),
        [F.col("colored_pixels").desc(), "annotation", "filename"],
        n,
    ).select("annotation", "colored_pixels")


def least_colored_ratio(profile: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` images with the lowest coloured : transparent ratio.

    Ordering by coloured / total gives the same order as coloured /
    transparent and stays defined when nothing is transparent; an image
    without pixels has ratio 0. ``colored_ratio`` is null when no pixel is
    transparent.
    """
    share = F.coalesce(F.try_divide(F.col("colored_pixels"), F.col("total_pixels")), F.lit(0.0))
    ranked = top_k(profile, [share.asc(), "annotation", "filename"], n)
    return ranked.select(
        "annotation",
        "colored_pixels",
        "transparent_pixels",
        F.round(F.try_divide(F.col("colored_pixels"), F.col("transparent_pixels")), 4).alias("colored_ratio"),
    )


def top_colors_share(profile: DataFrame, n: int = 3, annotation: str | None = None) -> DataFrame:
    """The ``n`` most common colours per image with their share of the
    coloured pixels in percent (2 decimals); one image when ``annotation`` is set."""
    rows = profile if annotation is None else profile.filter(F.col("annotation") == annotation)
    top = rows.select(
        "annotation",
        "filename",
        "colored_pixels",
        F.posexplode(F.slice("palette", 1, n)).alias("pos", "c"),
    )
    return top.select(
        "annotation",
        (F.col("pos") + 1).alias("rank"),
        F.col("c.color").alias("color"),
        F.col("c.pixels").alias("pixels"),
        F.round(F.try_divide(F.col("c.pixels"), F.col("colored_pixels")) * 100, 2).alias("share"),
    )


def top_color_names(n: int = 3) -> Column:
    return F.transform(F.slice("palette", 1, n), lambda e: e["color"])


def color_signature_count(profile: DataFrame, colors: Sequence[str]) -> DataFrame:
    """How many images have exactly ``colors`` as their most common colours, in order."""
    wanted = F.array(*[F.lit(c) for c in colors])
    return profile.agg(
        F.count_if(top_color_names(len(colors)) == wanted).alias("images")
    ).select(F.lit("-".join(colors)).alias("signature"), "images")


def most_of_color(profile: DataFrame, color: str, group: str, n: int = 5) -> DataFrame:
    """The ``n`` images of ``group`` with most pixels of ``color`` and that count."""
    count = F.aggregate(
        F.filter("palette", lambda e: e["color"] == color), F.lit(0).cast("long"), lambda acc, e: acc + e["pixels"]
    )
    candidates = (
        profile.filter(F.col("group") == group)
        .select("annotation", "filename", count.alias("pixels"))
        .filter(F.col("pixels") > 0)
    )
    return top_k(candidates, [F.col("pixels").desc(), "annotation", "filename"], n).select(
        "annotation", F.col("pixels").alias(f"{color.lower()}_pixels")
    )
