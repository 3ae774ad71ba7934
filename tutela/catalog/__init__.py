"""Every operator bound to the supplied tables, with an equivalent SQL text."""
