"""Image addresses: validity, resolution variants, storage paths, fallbacks, byte checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .text import replace_first

# Marks in image addresses and the storage suffix of each resolution.
MISSING_MARK = "image-missing.svg"
RESOLUTION_MARKS = ["_in_1000x1000.", "_400w.", "_200w."]
FULL_MARK = "/cards/full/"
THUMB_MARK = "/cards/thumbs/"
SOURCE_SUFFIX = "_eg.jpg"
RESOLUTIONS = {"full": "_in_1000x1000", "high": "_400w", "low": "_200w"}
_VARIANT = r"_[^.]+\."


@dataclass(frozen=True)
class ImagePolicy:
    """Deployment values of the image rules."""

    source_host: str
    placeholder_url: str
    root: str = "card-images"


def is_valid_image_url(url: Column, policy: ImagePolicy) -> Column:
    """Present, not the missing-image drawing, and marked as an image of its host."""
    from_source = url.contains(SOURCE_SUFFIX) & (url.contains(FULL_MARK) | url.contains(THUMB_MARK))
    from_market = F.lit(False)
    for mark in RESOLUTION_MARKS:
        from_market = from_market | url.contains(mark)
    return F.coalesce(
        (url != "")
        & ~url.contains(MISSING_MARK)
        & F.when(url.contains(policy.source_host), from_source).otherwise(from_market),
        F.lit(False),
    )


def url_variants(url: Column, policy: ImagePolicy) -> Column:
    """Addresses of the three resolutions as a struct of ``full, high, low``."""
    source = url.contains(policy.source_host)
    thumb = source & url.contains(THUMB_MARK) & ~url.contains(FULL_MARK)
    full = source & url.contains(FULL_MARK)

    def market(mark: str) -> Column:
        return replace_first(url, _VARIANT, mark)

    return F.struct(
        F.when(thumb, F.lit(None)).when(source, url).otherwise(market(RESOLUTION_MARKS[0])).alias("full"),
        F.when(full, url).when(~source, market(RESOLUTION_MARKS[1])).alias("high"),
        F.when(thumb, url).when(~source, market(RESOLUTION_MARKS[2])).alias("low"),
    )


def image_path(group_id: Column, product_id: Column, resolution: str, policy: ImagePolicy) -> Column:
    return F.concat(
        F.lit(policy.root + "/"),
        group_id.cast("string"),
        F.lit("/"),
        product_id.cast("string"),
        F.lit(RESOLUTIONS[resolution] + ".jpg"),
    )


def resolved_urls(full: Column, high: Column, low: Column, policy: ImagePolicy) -> Column:
    """Each resolution falls back to the others, then to the placeholder."""
    rest = F.lit(policy.placeholder_url)
    return F.struct(
        F.coalesce(full, high, low, rest).alias("full_res_url"),
        F.coalesce(high, full, low, rest).alias("high_res_url"),
        F.coalesce(low, high, full, rest).alias("low_res_url"),
        F.coalesce(full, high, low).isNull().alias("is_placeholder"),
    )


def image_record(url: Column, policy: ImagePolicy) -> Column:
    """Addresses for one row with their origin; an unusable address gives placeholders and a reason."""
    usable = is_valid_image_url(url, policy)
    given = url_variants(url, policy)

    def when_usable(name: str) -> Column:
        return F.when(usable, given[name])

    urls = resolved_urls(when_usable("full"), when_usable("high"), when_usable("low"), policy)
    reason = (
        F.when(F.coalesce(url, F.lit("")) == "", F.lit("Image URL missing"))
        .when(~usable, F.lit("Invalid image URL"))
    )
    return F.struct(
        urls["full_res_url"].alias("full_res_url"),
        urls["high_res_url"].alias("high_res_url"),
        urls["low_res_url"].alias("low_res_url"),
        F.struct(
            urls["is_placeholder"].alias("is_placeholder"),
            url.alias("original_url"),
            reason.alias("error_message"),
        ).alias("metadata"),
    )


def image_kind(content: Column) -> Column:
    """``jpeg`` or ``png`` by the first bytes, else null."""
    head = F.hex(F.substring(content, 1, 4))
    return F.when(head.startswith("FFD8FF") & (F.length(content) >= 4), F.lit("jpeg")).when(
        head == "89504E47", F.lit("png")
    )
