"""Pixel decoding and naive colour naming as built-in column expressions.

``pixel_hex`` splits binary image data into one upper-case hex string per
pixel; ``pixel_color`` names the basic colour of one BGRA pixel. Both are
plain JVM expressions (``hex``, ``substring``, text comparisons, an array
lookup), compiled by whole-stage code generation when used outside a lambda.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The basic colour of each (red, green, blue) after every
# channel is rounded to 0, 128 or 255. 27 entries, in channel order.
BASIC_COLORS: dict[tuple[int, int, int], str] = {
    (0, 0, 0): "Black",
    (0, 0, 128): "Blue",
    (0, 0, 255): "Blue",
    (0, 128, 0): "Green",
    (0, 128, 128): "Green",
    (0, 128, 255): "Blue",
    (0, 255, 0): "Green",
    (0, 255, 128): "Green",
    (0, 255, 255): "Blue",
    (128, 0, 0): "Red",
    (128, 0, 128): "Purple",
    (128, 0, 255): "Purple",
    (128, 128, 0): "Green",
    (128, 128, 128): "Gray",
    (128, 128, 255): "Purple",
    (128, 255, 0): "Green",
    (128, 255, 128): "Green",
    (128, 255, 255): "Blue",
    (255, 0, 0): "Red",
    (255, 0, 128): "Pink",
    (255, 0, 255): "Purple",
    (255, 128, 0): "Orange",
    (255, 128, 128): "Orange",
    (255, 128, 255): "Pink",
    (255, 255, 0): "Yellow",
    (255, 255, 128): "Yellow",
    (255, 255, 255): "White",
}
# Channel rounding thresholds, the opacity cut and the name
# given to transparent or malformed pixels. The cuts are compared as two
# upper-case hex digits (0x55 = 85, 0xAA = 170, 0x80 = 128): for valid hex
# pairs, text order is numeric order, so no number parsing is needed.
LOW_CUT, HIGH_CUT = "55", "AA"
OPAQUE_FROM = "80"
TRANSPARENT = "None"
HEX_PIXEL = "^[0-9a-fA-F]{8}"
LEVELS = (0, 128, 255)


def pixel_hex(data: Column, channels: Column) -> Column:
    """Array of hex strings, ``channels`` bytes (2 * channels digits) each.

    The hex text is cut into consecutive chunks by one regular expression
    (``.{1,W}``: a short last chunk is kept, as with a partial pixel). Empty
    or missing data gives an empty array.
    """
    digits = F.hex(data)
    width = channels * 2
    chunk = F.concat(F.lit("(.{1,"), width.cast("string"), F.lit("})"))
    usable = (F.length(digits) > 0) & (channels > 0)
    return F.when(usable, F.regexp_extract_all(digits, chunk, F.lit(1))).otherwise(
        F.array().cast("array<string>")
    )


def _level(pair: Column) -> Column:
    """Index 0, 1, 2 of the channel rounded to 0, 128 or 255."""
    return F.when(pair < LOW_CUT, 0).when(pair < HIGH_CUT, 1).otherwise(2)


def _names_by_index() -> Column:
    """The 27 colour names as an array indexed by red * 9 + green * 3 + blue levels."""
    names = [BASIC_COLORS[(r, g, b)] for r in LEVELS for g in LEVELS for b in LEVELS]
    return F.array(*[F.lit(n) for n in names])


def pixel_color(hex_pixel: Column) -> Column:
    """Basic colour of a BGRA pixel; ``None`` when alpha < 128 or malformed."""
    h = F.upper(hex_pixel)
    blue, green, red = (_level(F.substring(h, pos, 2)) for pos in (1, 3, 5))
    opaque = F.substring(h, 7, 2) >= OPAQUE_FROM
    valid = F.coalesce(hex_pixel.rlike(HEX_PIXEL), F.lit(False))
    name = F.element_at(_names_by_index(), red * 9 + green * 3 + blue + 1)
    return F.when(valid & opaque, name).otherwise(F.lit(TRANSPARENT))
