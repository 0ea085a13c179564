"""Path, name and link expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the naming rules.
TEXTURE_URL_PATTERN = r"(?:texture_url|color_url)=([^&]+)"
READING_NAME_PATTERN = r"manometer_(\d+)_(\d+)"
RANGE_NAME_PATTERN = r"^(\d+(?:\.\d+)?)-(\d+(?:\.\d+)?)$"
TEMPLATE_GROUP_MARK = "gabarito"
UNSORTABLE_NAME_KEY = 1e9
COMMENT_PATTERN = r"(?s)<!--.*?-->"
RAW_TEXT_PATTERN = r"(?is)(<script\b[^>]*>|<style\b[^>]*>).*?(</script|</style)"
TAG_PATTERN = r"""(?s)<[a-zA-Z](?:[^<>"']|"[^"]*"|'[^']*')*>"""
ATTRIBUTE_PATTERN = r"""(?s)\s[^\s=<>"'/]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+)"""
LINK_ATTRIBUTE_PATTERN = r"""(?is)^\s(?:href|src)\s*=\s*["']?([^"']*)"""
REMOTE_PREFIXES = ("#", "http:", "https:", "data:")


def asset_group(relative_path: Column, root_name=None) -> Column:
    """First folder of the path, else the root's own name (NULL when none is given)."""
    root_name = root_name if isinstance(root_name, Column) else F.lit(root_name).cast("string")
    parts = F.split(relative_path, "/")
    return F.when(F.size(parts) > 1, parts[0]).otherwise(root_name)


def reading_class(stem: Column, group: Column) -> Column:
    """Class of a gauge image: its folder, else ``a.b`` from the name, else the name."""
    whole = F.regexp_extract(stem, READING_NAME_PATTERN, 1)
    tenth = F.regexp_extract(stem, READING_NAME_PATTERN, 2)
    return (
        F.when(group.isNotNull() & (group != ""), group)
        .when(whole != "", F.concat(whole, F.lit("."), tenth))
        .otherwise(stem)
    )


def numbered_class(stem: Column, group: Column) -> Column:
    """Class of a numbered image; template groups drop the trailing number."""
    template = F.contains(F.lower(F.coalesce(group, F.lit(""))), F.lit(TEMPLATE_GROUP_MARK))
    return F.when(template, F.regexp_replace(stem, r"(^|_)\d+$", "")).otherwise(stem)


def range_sort_key(name: Column) -> Column:
    """Numeric key of a class name: start of a range, the number itself, or last."""
    start = F.regexp_extract(name, RANGE_NAME_PATTERN, 1)
    return F.coalesce(
        F.when(start != "", start.try_cast("double")), name.try_cast("double"), F.lit(UNSORTABLE_NAME_KEY)
    )


def texture_url(preview_url: Column) -> Column:
    """First texture or colour URL named in a query string or fragment."""
    return first_listed_url(preview_url, TEXTURE_URL_PATTERN)


def first_listed_url(url: Column, pattern: str) -> Column:
    """Captured value, url-decoded, first comma item, trimmed; NULL when empty."""
    raw = F.regexp_extract(url, pattern, 1)
    first = F.trim(F.split(F.try_url_decode(raw), ",")[0])
    return F.nullif(first, F.lit(""))


def redact_path(value: Column) -> Column:
    """Absolute or path-like values keep only their last component."""
    bare = F.regexp_replace(value, r"[/\\]+$", "")
    return F.when(value.rlike(r"[/\\]"), F.regexp_extract(bare, r"([^/\\]*)$", 1)).otherwise(value)


def local_link_values(html: Column) -> Column:
    """Values of all href and src attributes, quoted or not, that point inside the site.

    Comments and the content of scripts and styles hold no tags.
    """
    plain = F.regexp_replace(F.regexp_replace(html, COMMENT_PATTERN, ""), RAW_TEXT_PATTERN, "$1$2")
    tags = F.regexp_extract_all(plain, F.lit(TAG_PATTERN), 0)
    attributes = F.flatten(F.transform(tags, lambda tag: F.regexp_extract_all(tag, F.lit(ATTRIBUTE_PATTERN), 0)))
    found = F.transform(attributes, lambda a: F.regexp_extract(a, LINK_ATTRIBUTE_PATTERN, 1))

    def is_local(value: Column) -> Column:
        keep = F.length(value) > 0
        for prefix in REMOTE_PREFIXES:
            keep = keep & ~F.startswith(value, F.lit(prefix))
        return keep

    return F.filter(found, is_local)
