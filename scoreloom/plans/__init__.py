"""The daily run and the tables behind the dashboard panels."""
