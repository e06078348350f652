"""Reading, writing, catalog and file layout."""
