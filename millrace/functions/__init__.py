"""Column expressions and driver-side literals."""
