"""Every operator bound to the given tables, with an independent SQL twin."""
