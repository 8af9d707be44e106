"""Customer-feedback analytics on Spark: unify, mask, label, group, publish, explore."""
