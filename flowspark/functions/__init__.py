"""Column functions and the small dense-algebra helper used by the grouped solve."""
