"""DataFrame -> DataFrame building blocks, independent of any one schema."""
