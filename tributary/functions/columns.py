"""Column expressions for features, files, images and tensors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def income_per_person(income: Column, children: Column) -> Column:
    """Income over children + 1, where no child counts as one."""
    return income / (F.when(children == 0, 1).otherwise(children) + 1)


def credit_to_income(credit: Column, income: Column) -> Column:
    """Credit over income, where no income counts as 1."""
    return credit / F.when(income == 0, 1).otherwise(income)


def payment_diff(paid: Column, due: Column) -> Column:
    return paid - due


def late_flag(days: Column) -> Column:
    """1 if positive, else 0, also for NULL."""
    return F.when(days > 0, 1).otherwise(0)


def status_past_due(status: Column) -> Column:
    """Whether the status text holds one of the digits 2 to 5."""
    return status.cast("string").rlike("[2345]")


def strip_affixes(name: Column, prefix: str = "", suffix: str = "") -> Column:
    """The name with prefix and suffix texts removed wherever they stand."""
    for affix in filter(None, (prefix, suffix)):
        name = F.replace(name, F.lit(affix), F.lit(""))
    return name


def relative_path(path: Column, root: str) -> Column:
    return F.regexp_replace(path, "^" + root.rstrip("/").replace(".", r"\.") + "/", "")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def filled_pattern(pattern: str, folder: Column, identifier: Column) -> Column:
    """A file name pattern with * as the folder's name and {id} as the identifier."""
    return F.replace(F.replace(F.lit(pattern), F.lit("*"), folder), F.lit("{id}"), identifier)


def middle_slice(volume: Column, depth: Column) -> Column:
    """The middle plane of an array of planes."""
    return F.get(volume, F.floor(depth / 2).cast("int"))


def minmax_uint8(pixels: Column) -> Column:
    """(x - min) / (max - min) * 255, cut to whole numbers; unchanged (but cut) if max is not positive or equals min."""
    low, high = F.array_min(pixels), F.array_max(pixels)
    scaled = F.transform(pixels, lambda x: ((x - low) / F.nullif(high - low, F.lit(0.0)) * 255).cast("int"))
    return F.when((high > 0) & (high > low), scaled).otherwise(F.transform(pixels, lambda x: x.cast("int")))


def to_unit_interval(pixels: Column) -> Column:
    return F.transform(pixels, lambda x: x / 255.0)


def grayscale(blue: Column, green: Column, red: Column) -> Column:
    """Luma by the ITU-R 601 weights."""
    return 0.299 * red + 0.587 * green + 0.114 * blue


def binarize(pixels: Column, threshold: float = 0.0) -> Column:
    return F.transform(pixels, lambda x: F.when(x > threshold, 1.0).otherwise(0.0))


def channel_normalise(pixels: Column, mean: float = 0.1307, deviation: float = 0.3081) -> Column:
    return F.transform(pixels, lambda x: (x - mean) / deviation)


def nonempty(mask: Column) -> Column:
    """Whether a mask has a pixel other than zero."""
    return F.exists(mask, lambda x: x != 0)
