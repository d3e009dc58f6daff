from segrec.sources.json import dedupe_documents, read_documents, read_recommendations, require_columns  # noqa: F401
from segrec.sources.tables import (  # noqa: F401
    TABLE_GENRES,
    items_from_tables,
    ratings_from_tables,
    table,
)
from segrec.sources.text import (  # noqa: F401
    dedupe_items,
    quarantine_ratings,
    read_items,
    read_ratings,
    render_items_lines,
    render_ratings_lines,
    usable_ratings,
    valid_ratings,
)
