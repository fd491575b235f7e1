"""Training-data operators for web-scale text tables; nothing else in the package imports this one."""
