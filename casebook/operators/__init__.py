"""Table-to-table operators: upserts, normalisation, selection, discovery, classification, pages, reports."""
