"""What a document title tells: version, base name, noise, type, and the link to show."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.text import is_filled, rstrip, strip

# Fixed value: a version tag inside a file name, such as _V3 or -v02.
VERSION_TAG = r"(?iU)[_\s-]v(\d+)([_.\s]|$)"

# Titles of internal files that are never about one project.
# {org} is the name the organisation puts in front of its purchase lists.
NOISE_TITLES = (
    r"(?iU)Utilization_Report|PLANNING\s|{org}_Purchased|project.categories|\bJira\b|^TV\s*-\s*\d|_OP\s+Summary_|Handover_"
)

# File name endings of every document type.
PRESENTATION = (".pptx", ".ppt")
DESIGN = (".psd", ".ai", ".eps")
IMAGE = (".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg")
WORD = (".docx", ".doc")
SHEET = (".xlsx", ".xls", ".csv")
VIDEO = (".mp4", ".mov", ".avi")


def version_number(title: Column) -> Column:
    """Number of the first version tag, 0 without one."""
    found = F.regexp_extract(title, VERSION_TAG, 1)
    return F.coalesce(F.nullif(found, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def base_name(title: Column) -> Column:
    """Title without version tags, to compare the versions of one file."""
    return F.lower(rstrip(F.regexp_replace(title, VERSION_TAG, ""), "._- "))


def noise_pattern(org: str = "Agency") -> str:
    return NOISE_TITLES.replace("{org}", org)


def is_noise(title: Column, org: str = "Agency") -> Column:
    return title.rlike(noise_pattern(org))


def is_quote(title: Column) -> Column:
    return F.upper(title).startswith("CE_")


def is_order_summary(title: Column) -> Column:
    return title.contains("_OP Summary_") | title.contains("_OP_Summary_")


def clickable_url(url: Column) -> Column:
    """The stripped link when it is http or https, else the empty string."""
    link = strip(F.coalesce(url, F.lit("")))
    return F.when(F.lower(link).startswith("http://") | F.lower(link).startswith("https://"), link).otherwise("")


def best_url(source_url: Column, url: Column) -> Column:
    shown = clickable_url(source_url)
    return F.when(is_filled(shown), shown).otherwise(clickable_url(url))


def _ends(lowered: Column, endings: tuple[str, ...]) -> Column:
    found = lowered.endswith(endings[0])
    for ending in endings[1:]:
        found = found | lowered.endswith(ending)
    return found


def document_type(title: Column) -> Column:
    """Type label from the ending and the start of a title; the first rule that holds decides."""
    low = F.lower(title)
    quote = low.startswith("ce_")
    pdf = (
        F.when(low.contains("quote") | quote, "Cost Estimate")
        .when(low.contains("_op summary") | low.contains("po"), "PO Summary")
        .otherwise("PDF Deliverable")
    )
    return (
        F.when(_ends(low, PRESENTATION), "Presentation")
        .when(low.endswith(".pdf"), pdf)
        .when(low.endswith(".indd"), "InDesign File")
        .when(_ends(low, DESIGN), "Design Asset")
        .when(_ends(low, IMAGE), "Image Asset")
        .when(_ends(low, WORD), "Word Document")
        .when(_ends(low, SHEET), "Spreadsheet")
        .when(_ends(low, VIDEO), "Video")
        .when(quote, "Cost Estimate")
        .otherwise("Document")
    )
