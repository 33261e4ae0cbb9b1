"""Files, reports, pages and models, in and out."""
