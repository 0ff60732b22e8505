"""Column -> Column functions.  All are built from Spark's own functions, so
they stay inside whole-stage code generation; the two exceptions (exact
matching-blocks ratio and NFKD) live in ``fuzzy`` as Arrow-batched UDFs."""
