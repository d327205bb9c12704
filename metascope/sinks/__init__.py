"""Writing results: text files, tables, and the export of whole listings."""
