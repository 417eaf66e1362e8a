"""Text expressions: folder names, labels, log text and page checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from regflow.schema import REPORT_FILE, Grain

# White space as the source's text functions see it: Unicode plus the file separators.
_SPACE = r"[\s\x1C-\x1F]"
_LINE_BREAK = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"

# Fixed pattern: "<office> - <CODE>(" at the start of an office label.
_OFFICE_LABEL = r"(?d)^(.*) - ([A-Z0-9]+)\("

# Fixed pattern: title row of a legacy report.
_HISTORY_TITLE = (
    r"Vehicle Class Wise Fuel Data\s+of\s+([A-Za-z &]+)\s+\((\w+),(\d{4})\)"
)

# Title and texts of a block page, checked in this order.
BLOCKED_TITLE = "Access Forbidden"
BLOCKED_MARKERS = (
    "Access Forbidden",
    "You don’t have permission to access this page",
    "You don't have permission to access this page",
)


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(text, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def strip_right(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){_SPACE}+\z", "")


def remove_special(text: Column) -> Column:
    """One space for each run of characters that are not letters, numbers or underscore."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}_]+", " ")


def state_folder(state: Column) -> Column:
    """Folder name of a state: every non-letter becomes a space, right end stripped."""
    return strip_right(F.regexp_replace(state, r"(?U)[^a-zA-Z\s]", " "))


def class_folder(vehicle_class: Column) -> Column:
    return F.rtrim(remove_special(vehicle_class))


def class_key(vehicle_class: Column) -> Column:
    """Mapping-side spelling of a vehicle class: as the folder, stripped at both ends."""
    return strip(remove_special(vehicle_class))


def office_code(label: Column) -> Column:
    """Code of an office label, NULL for a malformed label."""
    return F.when(label.rlike(_OFFICE_LABEL), F.regexp_extract(label, _OFFICE_LABEL, 2))


def office_folder(label: Column) -> Column:
    """`NAME - CODE(...` -> `NAME_CODE` without slashes; NULL for a malformed label."""
    name = strip(F.regexp_extract(label, _OFFICE_LABEL, 1))
    joined = F.concat(name, F.lit("_"), F.regexp_extract(label, _OFFICE_LABEL, 2))
    return F.when(
        label.rlike(_OFFICE_LABEL), strip(F.regexp_replace(joined, r"[\\/]", ""))
    )


def office_folder_code(folder: Column) -> Column:
    """Text after the last underscore; empty when there is none."""
    return F.when(
        folder.contains("_"), F.substring_index(folder, "_", -1)
    ).otherwise(F.when(folder.isNotNull(), F.lit("")))


def office_folder_name(folder: Column) -> Column:
    """Text before the last underscore; everything when there is none."""
    return F.when(
        folder.contains("_"),
        F.left(folder, F.length(folder) - F.length(F.substring_index(folder, "_", -1)) - 1),
    ).otherwise(folder)


def label_has_code(label: Column, code: Column) -> Column:
    """Exact code match inside a label: HR2 does not match HR29."""
    return F.contains(label, F.concat(F.lit(" - "), code, F.lit("(")))


def report_path(
    grain: Grain,
    root: str,
    state: Column,
    year: Column,
    month: Column,
    member: Column | None = None,
) -> Column:
    """Expected path of a report. `member` is the office label or the vehicle class."""
    folders = [state_folder(state)]
    if "Office" in grain.folders:
        folders.append(office_folder(member))
    elif "Vehicle Class" in grain.folders:
        folders.append(class_folder(member))
    parts = [F.lit(root), *folders, year.cast("string"), month, F.lit(REPORT_FILE)]
    # NULL when a part is NULL: a malformed office label has no path.
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit("/"), part]
    return F.concat(*pieces)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def varchar(text: Column, width: int) -> Column:
    """Cut to `width` characters, as a cast to a bounded text type does in the source."""
    return F.substring(text, 1, width)


def history_title(title: Column, part: str) -> Column:
    """State, month or year of a legacy title row; NULL when the title does not match."""
    group = {"state": 1, "month": 2, "year": 3}[part]
    return F.when(title.rlike(_HISTORY_TITLE), F.regexp_extract(title, _HISTORY_TITLE, group))


def context_text(context: Column) -> Column:
    """Map -> `k=v, k=v` in key order, without NULL and empty values."""
    kept = F.map_filter(context, lambda _, v: v.isNotNull() & (v != ""))
    entries = F.array_sort(F.map_entries(kept))
    text = F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", "
    )
    return F.coalesce(text, F.lit(""))


def artifact_label(text: Column, max_length: int = 80) -> Column:
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9._-]+", "_")
    clean = F.btrim(clean, F.lit("_"))
    return F.substring(F.coalesce(F.nullif(clean, F.lit("")), F.lit("unknown")), 1, max_length)


def first_message_line(error_class: Column, message: Column) -> Column:
    """`Class: first useful line`, skipping blanks, driver headings and `#` frames."""
    lines = F.transform(F.split(F.coalesce(message, F.lit("")), _LINE_BREAK), strip)
    useful = F.filter(
        lines,
        lambda line: (line != "")
        & ~line.isin("Message:", "Stacktrace:")
        & ~line.startswith("#"),
    )
    return F.concat(
        error_class, F.lit(": "), F.coalesce(F.try_element_at(useful, F.lit(1)), error_class)
    )


def blocked_reason(
    title: Column,
    html: Column,
    blocked_title: str = BLOCKED_TITLE,
    markers: Sequence[str] = BLOCKED_MARKERS,
) -> Column:
    """Why a fetched page counts as blocked: its exact title, else the first marker found."""
    reason = F.when(
        strip(F.coalesce(title, F.lit(""))) == blocked_title,
        F.lit("page_title_access_forbidden"),
    )
    for marker in markers:
        label = F.concat(
            F.lit("page_source_contains_"), artifact_label(F.lit(marker.lower()))
        )
        reason = reason.when(F.contains(html, F.lit(marker)), label)
    return reason
