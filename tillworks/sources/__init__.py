"""Reading and writing: files, month partitions, published tables."""
