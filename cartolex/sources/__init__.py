"""Sources: link lists, files, pages."""
