"""Reading and writing: landed documents, tables, published intermediates, the demo feed."""
