"""The daily run over a stream of landed documents."""
