"""Where to split a two-page scan: decisions on brightness and edge profiles of its columns.

Profiles are arrays, one number per pixel column; the decisions are array expressions. Reading pixels
is left to an image reader (``foliant.sources.remote``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OVERLAP = 10


def column_means(rows: Column) -> Column:
    """Mean brightness of each pixel column of a grey image, given as an array of rows of equal length."""
    width = F.size(F.get(rows, F.lit(0)))
    total = lambda c: F.aggregate(rows, F.lit(0.0), lambda a, r: a + F.get(r, c).cast("double"))
    return F.when(F.size(rows) > 0, F.transform(F.sequence(F.lit(0), width - 1), lambda c: total(c) / F.size(rows)))


def column_counts(rows: Column) -> Column:
    """Number of set pixels of each pixel column of an edge image, given as an array of rows of equal length."""
    width = F.size(F.get(rows, F.lit(0)))
    count = lambda c: F.size(F.filter(rows, lambda r: F.get(r, c) > 0))
    return F.when(F.size(rows) > 0, F.transform(F.sequence(F.lit(0), width - 1), count))


def centre_window(profile: Column, part: int) -> tuple[Column, Column]:
    """(start, values) of the middle 1/``part``-th of a profile; start counts from 0."""
    width = F.size(profile)
    size = F.floor(width / part).cast("int")
    start = (F.floor(width / 2) - F.floor(size / 2)).cast("int")
    return start, F.slice(profile, start + 1, F.greatest(size, F.lit(1)))


def shadow_split(brightness: Column, threshold: float = 50.0, slack: float = 10.0, least: int = 5) -> Column:
    """Middle of the dark columns around the darkest of the centre; null if none is dark enough or they are too few."""
    start, window = centre_window(brightness, 4)
    darkest = F.array_min(window)
    at = F.filter(F.transform(window, lambda v, i: F.when(v <= darkest + slack, i)), lambda i: i.isNotNull())
    middle = start + F.floor((F.element_at(at, 1) + F.element_at(at, -1)) / 2).cast("int")
    return F.when((F.size(window) > 0) & (darkest <= threshold) & (F.size(at) >= least), middle)


def geometric_split(edges: Column) -> Column:
    """The column with most edge pixels in the middle third, the first of equals; without edges the middle."""
    start, window = centre_window(edges, 3)
    most = F.array_max(window)
    return F.when(most > 0, start + F.array_position(window, most).cast("int") - 1).otherwise(F.floor(F.size(edges) / 2).cast("int"))


def split_at(brightness: Column, edges: Column, threshold: float = 50.0) -> Column:
    return F.coalesce(shadow_split(brightness, threshold), geometric_split(edges))


def halves(split: Column, width: Column) -> Column:
    """Column ranges (half-open) of the left and right page, overlapping at the split."""
    return F.struct(F.lit(0).alias("left_from"), F.least(split + OVERLAP, width).alias("left_to"), F.greatest(split - OVERLAP, F.lit(0)).alias("right_from"), width.alias("right_to"))


def crop_command(source: Column, target: Column, x: Column, width: Column, height: Column) -> Column:
    """The command line that crops a page out of a scan."""
    return F.format_string("magick '%s' -crop %dx%d+%d+0 +repage '%s'", source, width, height, x, target)


def fitted(width: Column, height: Column, page_width: float = 595.276, page_height: float = 841.89) -> Column:
    """Scale and place of an image centred on an A4 page, in points."""
    scale = F.least(page_width / width, page_height / height)
    return F.struct(scale.alias("scale"), ((page_width - width * scale) / 2).alias("x"), ((page_height - height * scale) / 2).alias("y"))
