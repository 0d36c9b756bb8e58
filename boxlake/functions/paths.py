"""File names, split folders and stored image paths as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxlake.schema import OTHER_SPLIT_ID, SPLIT_IDS

# The split folder must be the one right above images/ or labels/, so that a dataset
# stored below a folder called "test" is not taken for the test split.
SPLIT_PATTERN = r"/(train|valid|test)/(?:images|labels)/[^/]+$"


def plain_path(path: Column) -> Column:
    """Undo URL encoding of `_metadata.file_path` and of image origins.

    `url_decode` would also turn a plus sign into a blank, hence the detour.
    """
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def split_from_path(path: Column) -> Column:
    return F.regexp_extract(path, SPLIT_PATTERN, 1)


def split_id(split_name: Column) -> Column:
    out = F.lit(OTHER_SPLIT_ID)
    for name, number in SPLIT_IDS.items():
        out = F.when(split_name == F.lit(name), F.lit(number)).otherwise(out)
    return out


def name_from_path(path: Column, extension: str) -> Column:
    """File name without its extension; empty when the extension differs."""
    return F.regexp_extract(path, rf"/([^/]+)\.{extension}$", 1)


def last_element(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(filename: Column) -> Column:
    """Base name without the last extension; a leading dot does not start an extension."""
    return F.regexp_replace(base_name(filename), r"(?<=.)\.[^.]+$", "")


def suffix(filename: Column) -> Column:
    """Last extension in lower case with its dot, or empty."""
    return F.lower(F.regexp_extract(base_name(filename), r"^.+(\.[^.]+)$", 1))


def base_name(filename: Column) -> Column:
    return F.regexp_extract(filename, r"([^/]*)$", 1)


def artifact_folder(run_id: Column, written_at: Column, token: Column) -> Column:
    """Folder of stored images: by run when there is a run, else by day and time."""
    by_day = F.concat(
        F.lit("images/"), F.date_format(written_at, "yyyy/MM/dd"), F.lit("/"),
        F.date_format(written_at, "yyyyMMdd_HHmmss"), F.lit("_"), token,
    )
    has_run = F.coalesce(run_id, F.lit("")) != F.lit("")
    return F.when(has_run, F.concat(F.lit("images/runs/"), run_id)).otherwise(by_day)


def artifact_paths(
    filename: Column, folder: Column, has_original: Column, has_annotated: Column
) -> tuple[Column, Column]:
    """Relative paths of the original and the annotated image; empty where there is no image."""
    extension = F.when(suffix(filename) == F.lit(""), F.lit(".jpg")).otherwise(suffix(filename))
    original = F.concat(folder, F.lit("/"), stem(filename), F.lit("_orig"), extension)
    annotated = F.concat(folder, F.lit("/"), stem(filename), F.lit("_ann.jpg"))

    def tidy(path: Column) -> Column:
        return F.replace(path, F.lit("\\"), F.lit("/"))

    empty = F.lit("")
    return (
        F.when(has_original, tidy(original)).otherwise(empty),
        F.when(has_annotated, tidy(annotated)).otherwise(empty),
    )


def inside_base(path: Column) -> Column:
    """True for a non-empty relative path that never climbs out of its base folder."""
    parts = F.split(path, "/")
    return (
        (path != F.lit(""))
        & ~path.startswith("/")
        & ~F.array_contains(parts, "..")
    )


def run_from_path(path: Column) -> Column:
    """Run folder in a stored path; empty when the path is not below a run."""
    return F.regexp_extract(path, r"runs/([^/]+)/", 1)
